"""What the plans must look like to hold for large inputs."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerspark.operators import declaration, income, merge, position, report
from ledgerspark.plans import catalog
from ledgerspark.plans.derived import Derived
from ledgerspark.schemas import TABLES

# These run jobs of their own while they are built, or write files first.
WRITES_FIRST = {
    "stream_incremental_import",
    "import_run_twice",
    "report_texts",
    "legacy_dump_rows",
    "legacy_first_block",
}
PYTHON = {"src_workbook_cells"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITES_FIRST))
def test_no_pairwise_join_and_no_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    if name not in PYTHON:
        assert not re.search(r"Python|InPandas|InArrow", plan)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty stored tables with the full schemas: scans show what is pushed to them."""
    folder = tmp_path_factory.mktemp("stored")
    for name, spec in TABLES.items():
        spark.createDataFrame([], spec.schema).write.parquet(str(folder / name))
    return lambda name: spark.read.parquet(str(folder / name))


def columns_read(plan: str) -> set[str]:
    return set().union(*map(names, re.findall(r"ReadSchema: struct<([^>]*)>", plan)))


def names(schema: str) -> set[str]:
    return set(re.findall(r"(\w+):", schema))


def test_year_is_a_range_in_the_scan(stored):
    plan = plan_of(income.income(stored("b3_movimentacao"), stored("b3_posicao_acoes"), 2024))
    assert "GreaterThanOrEqual(data_pregao,2024-01-01)" in plan
    assert "LessThan(data_pregao,2025-01-01)" in plan
    assert "In(movimentacao, [" in plan
    plan = plan_of(declaration.active_tickers(stored("b3_posicao_acoes"), stored("b3_posicao_emprestimos"), 2024))
    assert plan.count("GreaterThanOrEqual(data_pregao,2024-01-01)") == 2


def test_only_needed_columns_are_read(stored):
    movements, trades = stored("b3_movimentacao"), stored("b3_negociacao")
    plan = plan_of(position.net_splits(movements))
    assert columns_read(plan) <= {"taxpayer_id", "entrada_saida", "movimentacao", "produto", "quantidade"}
    assert "EqualTo(movimentacao,Desdobro)" in plan
    plan = plan_of(position.trade_counts(trades, "Compra"))
    assert columns_read(plan) <= {"taxpayer_id", "tipo_movimentacao", "ticker"}
    spec = TABLES["b3_posicao_acoes"]
    table = stored(spec.name)
    plan = plan_of(merge.new_rows(table, table, spec.key, ["id"]))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(names(r) == set(spec.key) for r in reads)


def test_first_per_key_is_cut_down_before_the_shuffle(stored):
    plan = plan_of(income.latest_position(stored("b3_posicao_acoes")))
    assert re.search(r"WindowGroupLimit .*Final", plan) and re.search(r"WindowGroupLimit .*Partial", plan)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_events_are_added_up_before_the_tax_id_join(stored):
    plan = plan_of(income.income(stored("b3_movimentacao"), stored("b3_posicao_acoes")))
    join = plan.index("Join")
    assert "partial_sum" in plan[join:] and "sum(" not in plan[:join]


def test_current_position_reads_trades_once(stored):
    names = ("b3_negociacao", "b3_movimentacao", "b3_bonificacao_acoes", "b3_posicao_acoes", "b3_posicao_emprestimos")
    plan = plan_of(position.position(*(stored(n) for n in names)))
    scans = [s for s in plan.splitlines() if "FileScan" in s]
    assert sum("b3_negociacao" in s for s in scans) == 1
    assert sum("b3_movimentacao" in s for s in scans) == 1
    assert sum("b3_bonificacao" in s for s in scans) == 1


def test_written_reports_keep_their_order_on_more_data(spark, tmp_path):
    lines = catalog._lines(Derived(spark, SF))
    report.write_reports(lines, str(tmp_path / "out"))
    for row in report.assemble_reports(lines).collect():
        folder = tmp_path / "out" / f"taxpayer_id={row.taxpayer_id}" / f"ano_base={row.ano_base}"
        (file,) = folder.glob("*.txt")
        assert file.read_text() == row.report


def test_hot_key_is_spread_over_tasks(spark, table, tmp_path):
    """A ticker with all trades is split at run time, into more tasks than there are partitions."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in conf}
    trades = spark.range(40_000).select(
        F.lit("tp").alias("taxpayer_id"), F.lit("A3").alias("ticker"), F.lit("Compra").alias("tipo_movimentacao"),
        F.hash("id").alias("quantidade"),
    )
    trades.repartition(40).write.parquet(str(tmp_path / "t"))
    moved = table(
        "b3_movimentacao", {"movimentacao": "Desdobro", "entrada_saida": "Credito", "quantidade": 5, "produto": "A3 - A"}
    )
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = position.trades_split_adjusted(spark.read.parquet(str(tmp_path / "t")), moved)
        tasks = rows.select(F.spark_partition_id().alias("task"), "quantidade_net").groupBy("task").count().collect()
        assert sum(r["count"] for r in tasks) == 40_000
        assert len(tasks) > 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_large_lookup_is_not_broadcast(spark, table):
    """The lookup of a row-level join is broadcast by its true size only."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    trades = spark.range(1000).select(
        F.lit("tp").alias("taxpayer_id"), F.concat(F.lit("A"), "id").alias("ticker"), F.lit("Compra").alias("tipo_movimentacao"),
        F.lit(1).alias("quantidade"),
    )
    moves = [
        {"movimentacao": "Desdobro", "entrada_saida": "Credito", "quantidade": 5, "produto": f"A{i} - A"} for i in range(1000)
    ]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
        rows = position.trades_split_adjusted(trades, table("b3_movimentacao", *moves))
        assert rows.filter("quantidade_net = 6").count() == 1000
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan[: plan.index("Initial Plan")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dump_lines_are_in_no_exchange(spark, tmp_path):
    """Dump lines stay where they are read, in one slice or in many."""
    from ledgerspark.sources import legacy_dump

    for n in range(5):
        (tmp_path / f"t{n}.sql").write_text(f"COPY public.movimentacao (a) FROM stdin;\nrow{n}\n\\.\n")
    for size in (2, 100):
        lines = legacy_dump.first_block_lines(spark, f"{tmp_path}/*.sql", slice_files=size)
        assert sorted(r.value for r in lines.collect()) == [f"row{n}" for n in range(5)]
        plan = lines._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("Initial Plan") :]
        assert "SortMergeJoin" not in plan and plan.count("Scan text") == 2 * (3 if size == 2 else 1)
