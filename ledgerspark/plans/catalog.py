"""Every operator as a query over the test tables, with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.fixed_values import (
    BUY,
    DIVIDEND,
    DIVIDEND_TRANSFERRED,
    EXEMPT_REIMBURSEMENT,
    FRACTION_AUCTION,
    JCP,
    JCP_TRANSFERRED,
    LENDING,
    MONETARY_UPDATE,
    REIMBURSEMENT,
    SECTION_OF_CATEGORY,
    SELL,
    TAXABLE_LENDING,
    ReportText,
)
from ledgerspark.functions import clean, keys
from ledgerspark.functions.text import (
    format_amount,
    format_tax_id,
    resolve_tax_id,
    without_float_suffix,
)
from ledgerspark.operators import bonus, declaration, income, ingest, merge, position, records, report
from ledgerspark.plans.derived import REGISTRY, Derived, movements_of, once
from ledgerspark.plans.files import movement_workbooks, write_contents, write_dumps
from ledgerspark.plans.import_run import run_import
from ledgerspark.plans.oracle import amount, bought_price, cents, divided, hugeint, money, query
from ledgerspark.schemas import MONEY, PRICE, TAXPAYER, table_spec
from ledgerspark.session import scratch_dir
from ledgerspark.sources import legacy_dump, reports, workbook
from ledgerspark.sources.tables import read_table
from ledgerspark.streaming.incremental import import_increment

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CELLS = [f"c{i}" for i in range(8)]
CUSTODY = table_spec("b3_posicao_acoes")
LOANS = table_spec("b3_posicao_emprestimos")
RECEIVED = table_spec("b3_proventos_recebidos")
REIMBURSED = table_spec("b3_reembolso_emprestimos")
BONUS_TABLE = table_spec("b3_bonificacao_acoes")


def _register(name: str, sql: str | None = None, **ctes: str):
    def add(build: Callable[[Derived], DataFrame]) -> Callable[[Derived], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Derived(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = query(sql, **ctes)
        return build

    return add


# --- Sources and cleaning ---------------------------------------------------------------------


@_register("src_workbook_cells", "SELECT taxpayer_id, 'Movimentação' AS sheet, c0, c1, c2, c3, c4, c5, c6, c7 FROM raw_movimentacao")
def _(d: Derived) -> DataFrame:
    cells = reports.with_owner(workbook.workbook_cells(movement_workbooks(d))).filter("row_idx > 0")
    return ingest.positional_columns(cells, CELLS, [TAXPAYER, "sheet"])


@_register(
    "src_tenant_from_path",
    "SELECT path, owner AS taxpayer_id, report, file_year AS ref_year FROM report_files WHERE named",
)
def _(d: Derived) -> DataFrame:
    return reports.with_owner(d.report_files()).drop("modificationTime")


@_register(
    "src_latest_file",
    "SELECT path, owner AS taxpayer_id, report, file_year AS ref_year FROM (SELECT *, row_number() OVER "
    "(PARTITION BY owner, report, file_year ORDER BY saved DESC, path) AS rn FROM report_files WHERE named) WHERE rn = 1",
)
def _(d: Derived) -> DataFrame:
    return reports.latest_files(reports.with_owner(d.report_files())).drop("modificationTime")


@_register(
    "src_sheet_route",
    """SELECT report, sheet, table_name, count(*) AS n_rows FROM (SELECT *, CASE
    WHEN report = 'negociacao' AND sheet_no = 0 THEN 'b3_negociacao' WHEN report = 'movimentacao' AND sheet_no = 0 THEN 'b3_movimentacao'
    WHEN report <> 'relatorio-consolidado-anual' THEN NULL WHEN sheet = 'Posição - Ações' THEN 'b3_posicao_acoes'
    WHEN sheet = 'Posição - Empréstimos' THEN 'b3_posicao_emprestimos' WHEN sheet = 'Proventos Recebidos' THEN 'b3_proventos_recebidos'
    WHEN sheet = 'Reembolsos de Empréstimo' THEN 'b3_reembolso_emprestimos' END AS table_name
    FROM sheets) WHERE table_name IS NOT NULL GROUP BY 1, 2, 3""",
    sheets="""SELECT CASE o_orderstatus WHEN 'F' THEN 'movimentacao' WHEN 'O' THEN 'relatorio-consolidado-anual' ELSE 'negociacao' END AS report,
    o_orderkey % 3 AS sheet_no, CASE o_custkey % 5 WHEN 0 THEN 'Posição - Ações' WHEN 1 THEN 'Posição - Empréstimos'
    WHEN 2 THEN 'Proventos Recebidos' WHEN 3 THEN 'Reembolsos de Empréstimo' ELSE 'Posição - ETF' END AS sheet FROM orders""",
)
def _(d: Derived) -> DataFrame:
    status, sheet = F.col("o_orderstatus"), F.col("o_custkey") % 5
    cells = d.source("orders").select(
        F.when(status == "F", "movimentacao")
        .when(status == "O", "relatorio-consolidado-anual")
        .otherwise("negociacao")
        .alias("report"),
        (F.col("o_orderkey") % 3).alias("sheet_no"),
        F.when(sheet == 0, "Posição - Ações")
        .when(sheet == 1, "Posição - Empréstimos")
        .when(sheet == 2, "Proventos Recebidos")
        .when(sheet == 3, "Reembolsos de Empréstimo")
        .otherwise("Posição - ETF")
        .alias("sheet"),
    )
    routed = ingest.route_sheets(cells)
    return routed.groupBy("report", "sheet", "table_name").agg(F.count(F.lit(1)).alias("n_rows"))


def _event_cells(d: Derived) -> DataFrame:
    """Received income as the three cells an annual sheet has, without the date."""
    amount = F.replace(F.col("valor_liquido").cast("string"), F.lit("."), F.lit(","))
    cells = F.array("produto", "tipo_evento", amount).alias("cells")
    return d.received().select(TAXPAYER, F.year("data_pregao").alias("ref_year"), cells)


_EVENT_SQL = "replace(cast(valor_liquido AS string), '.', ',') AS valor_liquido"


@_register(
    "ingest_positional_columns",
    f"SELECT taxpayer_id, produto, tipo_evento, {_EVENT_SQL}, cast(NULL AS string) AS data_pregao FROM b3_proventos_recebidos",
)
def _(d: Derived) -> DataFrame:
    return ingest.positional_columns(_event_cells(d), RECEIVED.column_names, [TAXPAYER])


@_register(
    "ingest_reference_date",
    f"SELECT taxpayer_id, produto, tipo_evento, {_EVENT_SQL}, data_pregao FROM b3_proventos_recebidos",
)
def _(d: Derived) -> DataFrame:
    rows = ingest.positional_columns(_event_cells(d), RECEIVED.column_names, [TAXPAYER, "ref_year"])
    dated = ingest.with_reference_date(rows, F.col("ref_year"))
    return dated.withColumn("data_pregao", clean.clean_date(F.col("data_pregao"))).drop("ref_year")


_MISSING_SQL = " + ".join(
    f"(CASE WHEN {c} IS NULL OR {c} IN ('-', '', ' ') THEN 1 ELSE 0 END)" for c in CELLS
)
_DENSE = f"SELECT * FROM raw_movimentacao WHERE {_MISSING_SQL} <= 3"


def _dense(d: Derived) -> DataFrame:
    return ingest.drop_sparse_rows(d.raw_movements(), CELLS)


@_register("ingest_drop_sparse", "SELECT * FROM dense", dense=_DENSE)
def _(d: Derived) -> DataFrame:
    return _dense(d)


def _number_sql(cell: str, kind: str) -> str:
    plain = f"replace(replace({cell}, '.', ''), ',', '.')"
    return f"cast(CASE WHEN {cell} = '-' THEN '0' ELSE {plain} END AS {kind})"


@_register(
    "ingest_clean_number",
    f"SELECT taxpayer_id, {_number_sql('c5', 'decimal(18,6)')} AS quantidade, {_number_sql('c6', 'decimal(18,6)')} AS preco_unitario, "
    f"{_number_sql('c7', 'decimal(18,2)')} AS valor_operacao FROM dense",
    dense=_DENSE,
)
def _(d: Derived) -> DataFrame:
    return _dense(d).select(
        TAXPAYER,
        clean.clean_cell(F.col("c5"), PRICE).alias("quantidade"),
        clean.clean_cell(F.col("c6"), PRICE).alias("preco_unitario"),
        clean.clean_cell(F.col("c7"), MONEY).alias("valor_operacao"),
    )


@_register(
    "ingest_clean_string",
    "SELECT taxpayer_id, trim(c2) AS movimentacao, trim(c3) AS produto, trim(c4) AS instituicao FROM raw_movimentacao",
)
def _(d: Derived) -> DataFrame:
    names = {"c2": "movimentacao", "c3": "produto", "c4": "instituicao"}
    cleaned = [clean.clean_string(F.col(c)).alias(n) for c, n in names.items()]
    return d.raw_movements().select(TAXPAYER, *cleaned)


@_register(
    "ingest_parse_date",
    "SELECT taxpayer_id, c2, CASE WHEN c1 = '-' THEN make_date(2100, 1, 1) ELSE make_date(cast(substr(c1, 7, 4) AS int), "
    "cast(substr(c1, 4, 2) AS int), cast(substr(c1, 1, 2) AS int)) END AS data_pregao FROM raw_movimentacao",
)
def _(d: Derived) -> DataFrame:
    return d.raw_movements().select(TAXPAYER, "c2", clean.clean_date(F.col("c1")).alias("data_pregao"))


@_register(
    "ingest_strip_float_suffix",
    "SELECT taxpayer_id, codigo_negociacao, split_part(cnpj, '.', 1) AS cnpj FROM b3_posicao_acoes",
)
def _(d: Derived) -> DataFrame:
    return d.custody().select(TAXPAYER, "codigo_negociacao", without_float_suffix(F.col("cnpj")).alias("cnpj"))


@_register(
    "ingest_cast_schema",
    """SELECT taxpayer_id, id, produto, instituicao, cast(conta AS decimal(18,0)) AS conta, codigo_negociacao, cnpj,
    cast(NULL AS string) AS codigo_isin, cast(NULL AS string) AS tipo, cast(NULL AS string) AS escriturador,
    cast(quantidade AS decimal(18,0)) AS quantidade, cast(NULL AS decimal(18,0)) AS quantidade_disp,
    cast(NULL AS decimal(18,0)) AS quantidade_indisp, cast(NULL AS string) AS motivo,
    cast(NULL AS decimal(18,6)) AS preco_fechamento, cast(NULL AS decimal(18,2)) AS valor_atualizado, data_pregao FROM b3_posicao_acoes""",
)
def _(d: Derived) -> DataFrame:
    as_integers = d.custody().withColumns(
        {"conta": F.col("conta").cast("int"), "quantidade": F.col("quantidade").cast("int")}
    )
    return ingest.cast_to_schema(as_integers, CUSTODY)


def _date_sql(column: str) -> str:
    parts = [f"lpad(cast(extract({p} FROM {column}) AS string), 2, '0'), '/', " for p in ("day", "month")]
    return f"concat({''.join(parts)}cast(extract(year FROM {column}) AS string))"


def _number_text_sql(column: str) -> str:
    whole = f"cast(floor({column}) AS bigint)"
    decimals = f"rtrim(split_part(cast(cast({column} AS decimal(18,6)) AS string), '.', 2), '0')"
    return f"concat(cast({whole} AS string), ',', CASE WHEN {decimals} = '' THEN '0' ELSE {decimals} END)"


_MOVEMENT_KEY_SQL = (
    f"concat(entrada_saida, {_date_sql('data_pregao')}, movimentacao, produto, {_number_text_sql('quantidade')}, "
    f"{_number_text_sql('preco_unitario')}, {_number_text_sql('valor_operacao')})"
)


@_register("key_movement", f"SELECT taxpayer_id, instituicao, {_MOVEMENT_KEY_SQL} AS pk_movimentacao FROM b3_movimentacao")
def _(d: Derived) -> DataFrame:
    return d.movements().select(TAXPAYER, "instituicao", keys.movement_key().alias("pk_movimentacao"))


@_register(
    "key_trade",
    f"SELECT taxpayer_id, instituicao, concat({_date_sql('data_negocio')}, tipo_movimentacao, ticker, cast(quantidade AS string), "
    f"{_number_text_sql('preco')}) AS pk_negociacao FROM b3_negociacao",
)
def _(d: Derived) -> DataFrame:
    return d.trades().select(TAXPAYER, "instituicao", keys.trade_key().alias("pk_negociacao"))


@_register(
    "key_surrogate",
    "SELECT taxpayer_id, produto, sha256(taxpayer_id || '|' || codigo_negociacao || '|' || cast(data_pregao AS string) || '|' || "
    "instituicao || '|' || cast(conta AS string)) AS id FROM b3_posicao_acoes",
)
def _(d: Derived) -> DataFrame:
    key = keys.surrogate_key(list(CUSTODY.natural_key))
    return d.custody().select(TAXPAYER, "produto", key.alias("id"))


@_register(
    "bonus_movements",
    "SELECT *  EXCLUDE (_source), cast(extract(year FROM data_pregao) AS int) AS ano_ref, trim(split_part(produto, '-', 1)) AS ticker "
    "FROM b3_movimentacao WHERE movimentacao = 'Bonificação em Ativos'",
)
def _(d: Derived) -> DataFrame:
    return bonus.bonus_movements(d.movements())


_CARD_SQL = """SELECT ticker, card_no, concat('01/02/', y) AS data_anuncio, concat('02/02/', y) AS data_com,
    concat('03/02/', y) AS data_ex, CASE WHEN y = '1996' THEN '-' ELSE concat('04/02/', y) END AS data_incorporacao,
    concat('R$ ', replace(cast(cast(valor_base AS decimal(18,2)) AS string), '.', ',')) AS valor_base, '10,00%' AS proporcao
    FROM (SELECT *, cast(ano_ref AS string) AS y FROM bonus_events)"""


@_register("bonus_page_cards", _CARD_SQL)
def _(d: Derived) -> DataFrame:
    return bonus.page_cards(d.bonus_pages())


@_register(
    "bonus_page_typed",
    """SELECT ticker, card_no, make_date(ano_ref, 2, 1) AS data_anuncio, make_date(ano_ref, 2, 2) AS data_com,
    make_date(ano_ref, 2, 3) AS data_ex, CASE WHEN ano_ref <> 1996 THEN make_date(ano_ref, 2, 4) END AS data_incorporacao,
    cast(valor_base AS decimal(18,6)) AS valor_base, cast(0.1 AS double) AS proporcao, cast(ano_ref AS int) AS ano_ref FROM bonus_events""",
)
def _(d: Derived) -> DataFrame:
    return bonus.typed_cards(bonus.page_cards(d.bonus_pages()))


@_register(
    "bonus_lookup_tickers",
    "SELECT ticker, html FROM bonus_pages WHERE ticker IN (SELECT trim(split_part(produto, '-', 1)) FROM b3_movimentacao "
    "WHERE movimentacao = 'Bonificação em Ativos')",
)
def _(d: Derived) -> DataFrame:
    return bonus.pages_to_read(d.bonus_pages(), d.movements())


@_register("bonus_enriched", "SELECT * EXCLUDE (_source) FROM b3_bonificacao_acoes")
def _(d: Derived) -> DataFrame:
    events = bonus.typed_cards(bonus.page_cards(d.bonus_pages()))
    return bonus.enrich_bonus(d.movements(), events)


@_register(
    "merge_bonus_events",
    "SELECT * EXCLUDE (rn, _source, card_no) FROM (SELECT *, row_number() OVER (PARTITION BY taxpayer_id, pk_movimentacao "
    "ORDER BY _source, card_no) AS rn FROM keyed) WHERE rn = 1",
    keyed="SELECT * FROM b3_bonificacao_acoes JOIN (SELECT _source, "
    f"{_MOVEMENT_KEY_SQL} AS pk_movimentacao FROM b3_movimentacao) USING (_source)",
)
def _(d: Derived) -> DataFrame:
    moved = d.movements_with(F.col("o_orderkey").alias("line")).withColumn("pk_movimentacao", keys.movement_key())
    priced = bonus.enrich_bonus(moved, d.bonus_events())
    order = ["line", "card_no"]
    existing = merge.first_per_key(priced.filter("data_pregao < date'1997-06-30'"), BONUS_TABLE.key, order)
    return merge.insert_ignore(existing, priced, BONUS_TABLE.key, order).drop(*order)


# --- Repeats, merge, imports ------------------------------------------------------------------


def _dedup_sql(table: str, key: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY taxpayer_id, {key} ORDER BY id) AS rn "
        f"FROM {table}) WHERE rn = 1"
    )


_EVENT_KEY_SQL = "produto, tipo_evento, data_pregao"


@_register("dedup_positions", _dedup_sql("b3_posicao_acoes", "codigo_negociacao, data_pregao, instituicao, conta"))
def _(d: Derived) -> DataFrame:
    return merge.keep_smallest_id(d.custody(), CUSTODY)


@_register("dedup_loans", _dedup_sql("b3_posicao_emprestimos", "num_contrato, data_pregao"))
def _(d: Derived) -> DataFrame:
    return merge.keep_smallest_id(d.loans(), LOANS)


@_register("dedup_income", _dedup_sql("b3_proventos_recebidos", _EVENT_KEY_SQL))
def _(d: Derived) -> DataFrame:
    return merge.keep_smallest_id(d.received(), RECEIVED)


@_register("dedup_reimbursements", _dedup_sql("b3_reembolso_emprestimos", _EVENT_KEY_SQL))
def _(d: Derived) -> DataFrame:
    return merge.keep_smallest_id(d.reimbursed(), REIMBURSED)


@_register("merge_insert_ignore", _dedup_sql("b3_proventos_recebidos", _EVENT_KEY_SQL))
def _(d: Derived) -> DataFrame:
    received = d.received()
    existing = merge.keep_smallest_id(received.filter("data_pregao < date'1998-06-30'"), RECEIVED)
    batch = received.unionByName(received.filter(F.col("tipo_evento") == DIVIDEND))
    return merge.insert_ignore(existing, batch, RECEIVED.key, [F.col("id")])


_SUMMARY_KEYS = {
    "b3_posicao_acoes": "codigo_negociacao, data_pregao, instituicao, conta",
    "b3_posicao_emprestimos": "num_contrato, data_pregao",
    "b3_proventos_recebidos": _EVENT_KEY_SQL,
    "b3_reembolso_emprestimos": _EVENT_KEY_SQL,
}


@_register(
    "import_summary",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_processed, "
        f"(SELECT count(*) FROM (SELECT DISTINCT taxpayer_id, {k} FROM {t})) AS rows_inserted, 'ok' AS status"
        for t, k in _SUMMARY_KEYS.items()
    ),
)
def _(d: Derived) -> DataFrame:
    tables = {CUSTODY: d.custody(), LOANS: d.loans(), RECEIVED: d.received(), REIMBURSED: d.reimbursed()}
    read, inserted = [], []
    for spec, rows in tables.items():
        name = F.lit(spec.name).alias("table_name")
        read.append(rows.select(name))
        inserted.append(merge.keep_smallest_id(rows, spec).select(name))
    return merge.import_summary(_union(read), _union(inserted))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@_register(
    "import_run_twice",
    """SELECT run, 'b3_movimentacao' AS table_name, (SELECT count(*) FROM dense) AS rows_processed,
    CASE run WHEN 'first' THEN (SELECT count(*) FROM (SELECT DISTINCT taxpayer_id, c0, c1, trim(c2), c3, c5, c6, c7 FROM dense)) ELSE 0 END
    AS rows_inserted, 'ok' AS status FROM (VALUES ('first'), ('second')) t(run)""",
    dense=_DENSE,
)
def _(d: Derived) -> DataFrame:
    folder = scratch_dir(d.spark, "reports")
    reports_at = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    write_contents(movement_workbooks(d), reports_at)
    runs = []
    for run in ("first", "second"):
        done = run_import(d.spark, folder, f"{folder}-tables", run, d.bonus_pages(), tables=["b3_movimentacao"])
        runs.append(done.withColumn("run", F.lit(run)))
    return _union(runs)


@_register(
    "stream_incremental_import",
    "SELECT * EXCLUDE (rn, _source) FROM (SELECT *, row_number() OVER (PARTITION BY taxpayer_id, pk_movimentacao "
    "ORDER BY instituicao) AS rn FROM keyed) WHERE rn = 1",
    keyed=f"SELECT *, {_MOVEMENT_KEY_SQL} AS pk_movimentacao FROM b3_movimentacao",
)
def _(d: Derived) -> DataFrame:
    def prepare(orders: DataFrame) -> DataFrame:
        return movements_of(orders).withColumn("pk_movimentacao", keys.movement_key())

    spec, folder = table_spec("b3_movimentacao"), scratch_dir(d.spark, "stream")
    # A pattern, because a file stream does not take the path of a single file.
    orders = f"{d.sf_dir}/orders.parquet*"
    # The second import sees every file again and must add nothing.
    for run in ("first", "second"):
        files = d.spark.readStream.schema(d.source("orders").schema).parquet(orders)
        checkpoint = f"{folder}/checkpoint-{run}"
        import_increment(files, prepare, f"{folder}/table", checkpoint, spec, ["instituicao"], run)
    return read_table(d.spark, f"{folder}/table", spec)


def _owner_of_dump():
    return F.regexp_extract("path", f"{TAXPAYER}=([^/]+)", 1)


@_register(
    "legacy_dump_rows",
    f"SELECT taxpayer_id, {_MOVEMENT_KEY_SQL} AS pk_movimentacao, entrada_saida, data_pregao, movimentacao, produto, "
    "CASE WHEN quantidade <> 3 THEN instituicao END AS instituicao, quantidade, preco_unitario, valor_operacao FROM b3_movimentacao",
)
def _(d: Derived) -> DataFrame:
    rows = legacy_dump.dump_rows(d.spark, write_dumps(d))
    return legacy_dump.legacy_table(rows, table_spec("b3_movimentacao"), _owner_of_dump())


@_register(
    "legacy_first_block",
    "SELECT DISTINCT m.taxpayer_id, cast(_source // 20000 AS bigint) AS dump, t.table_name, t.block_no FROM b3_movimentacao m "
    "CROSS JOIN (VALUES ('b3_movimentacao', 1), ('b3_proventos_recebidos', 4)) t(table_name, block_no)",
)
def _(d: Derived) -> DataFrame:
    first = legacy_dump.first_blocks(legacy_dump.dump_lines(d.spark, write_dumps(d)))
    return first.select(
        _owner_of_dump().alias(TAXPAYER),
        F.regexp_extract("path", r"file_no=(\d+)", 1).cast("long").alias("dump"),
        "table_name",
        "block_no",
    )


@_register(
    "legacy_nulls",
    f"SELECT taxpayer_id, {', '.join(f'''CASE WHEN {c} <> '-' THEN {c} END AS {c}''' for c in CELLS)} FROM raw_movimentacao",
)
def _(d: Derived) -> DataFrame:
    cells = d.raw_movements().select(TAXPAYER, legacy_dump.null_dashes(F.array(*CELLS)).alias("cells"))
    return ingest.positional_columns(cells, CELLS, [TAXPAYER])


# --- Views ------------------------------------------------------------------------------------


@_register("latest_position", "SELECT * FROM last_pos")
def _(d: Derived) -> DataFrame:
    return income.latest_position(d.custody())


@_register("view_bonus_income", "SELECT * FROM vw_bonus")
def _(d: Derived) -> DataFrame:
    return income.view_bonus_income(d.bonus(), d.custody())


@_register("view_income", "SELECT * FROM vw_income")
def _(d: Derived) -> DataFrame:
    return income.view_income(d.movements(), d.custody())


def _annual_income_sql(table: str) -> str:
    return f"""SELECT r.taxpayer_id, cast(extract(year FROM r.data_pregao) AS int) AS ano_base, split_part(r.produto, ' - ', 1) AS ticker,
    coalesce(pa.cnpj, '') AS cnpj, split_part(r.produto, ' - ', 2) AS nome_compania, r.tipo_evento AS movimentacao,
    cast(sum(r.valor_liquido) AS decimal(28,2)) AS valor_operacao FROM {table} r LEFT JOIN last_pos pa
    ON r.taxpayer_id = pa.taxpayer_id AND split_part(r.produto, ' - ', 1) = pa.ticker
    GROUP BY 1, 2, 3, 4, 5, 6 HAVING sum(r.valor_liquido) <> 0"""


@_register(
    "view_income_v1",
    f"{_annual_income_sql('b3_proventos_recebidos')} UNION ALL {_annual_income_sql('b3_reembolso_emprestimos')}",
)
def _(d: Derived) -> DataFrame:
    return income.income_from_annual(d.received(), d.reimbursed(), d.custody())


@_register("norm_fraction_ticker", "SELECT * FROM neg")
def _(d: Derived) -> DataFrame:
    return position.trades_by_instrument(d.trades())


@_register("net_splits", "SELECT taxpayer_id, ticker, split_shares AS qtd_lado FROM extras WHERE n_splits > 0")
def _(d: Derived) -> DataFrame:
    return position.net_splits(d.movements())


def _exact(rows: DataFrame, *columns: str) -> DataFrame:
    """Exact amounts as text, so that all of their digits are compared."""
    return rows.withColumns({c: F.col(c).cast("string") for c in columns})


_PRICES = ("preco_medio_compra", "posicao_fin")


def _splits_sql(side: str) -> str:
    """Split shares of a ticker over the number of its trades of a side, if it has any."""
    counted = f"""SELECT *, (SELECT count(*) FROM neg n
    WHERE n.taxpayer_id = x.taxpayer_id AND n.instrumento = x.ticker AND n.tipo_movimentacao = '{side}') AS n FROM extras x WHERE n_splits > 0"""
    shares = divided(counted, "part", hugeint("split_shares", 6), "6", "cast(n AS hugeint)", "0", "6")
    return f"SELECT taxpayer_id, ticker, {amount('part_u', 'part_s')} AS qtd_lado, split_shares AS qtd_lado_orig FROM ({shares})"


@_register("splits_per_buy", _splits_sql(BUY))
def _(d: Derived) -> DataFrame:
    return _exact(position.splits_per_trade(d.movements(), d.trades(), BUY), "qtd_lado")


@_register("splits_per_sell", _splits_sql(SELL))
def _(d: Derived) -> DataFrame:
    return _exact(position.splits_per_trade(d.movements(), d.trades(), SELL), "qtd_lado")


@_register(
    "trades_split_adjusted",
    "SELECT n.*, cast(n.quantidade + cast(coalesce(s.qtd_lado, '0') AS decimal(36,24)) AS varchar) AS quantidade_net FROM neg n LEFT JOIN shares s "
    "ON n.taxpayer_id = s.taxpayer_id AND n.instrumento = s.ticker",
    shares=_splits_sql(BUY),
)
def _(d: Derived) -> DataFrame:
    return _exact(position.trades_split_adjusted(d.trades(), d.movements()), "quantidade_net")


@_register(
    "bonus_totals",
    "SELECT taxpayer_id, ticker, bonus_shares AS quantidade, bonus_value AS valor_operacao FROM extras WHERE n_bonus > 0",
)
def _(d: Derived) -> DataFrame:
    return position.bonus_totals(d.bonus()).drop("n_bonus")


_BUY_COUNTS = (
    "SELECT taxpayer_id, instrumento AS ticker, count(*) AS n_compras FROM neg WHERE tipo_movimentacao = 'Compra' GROUP BY 1, 2"
)


@_register("buy_counts", _BUY_COUNTS)
def _(d: Derived) -> DataFrame:
    return position.buy_counts(d.trades())


_BONUS_PARTS = ("valor_bon_por_neg", "qtd_bon_por_neg")


def _bonus_parts_sql(rows: str, count: str) -> str:
    """Bonus totals with their quotients by a count."""
    n = f"cast({count} AS hugeint)"
    sql = divided(rows, "value", hugeint("valor_operacao", 2, "decimal(28,2)"), "2", n, "0", "2")
    sql = divided(sql, "gain", hugeint("quantidade", 6), "6", n, "0", "6")
    return f"""SELECT taxpayer_id, ticker, quantidade, valor_operacao, {amount("value_u", "value_s")} AS valor_bon_por_neg,
    {amount("gain_u", "gain_s")} AS qtd_bon_por_neg FROM ({sql})"""


@_register(
    "bonus_per_buy",
    _bonus_parts_sql(
        "SELECT taxpayer_id, ticker, bonus_shares AS quantidade, bonus_value AS valor_operacao, n_compras FROM extras "
        "LEFT JOIN n_buys USING (taxpayer_id, ticker) WHERE n_bonus > 0",
        "n_compras",
    ),
    n_buys=_BUY_COUNTS,
)
def _(d: Derived) -> DataFrame:
    return _exact(position.bonus_per_buy(d.bonus(), d.trades()), *_BONUS_PARTS)


# The second form has each bonus row once for every trade of its ticker, and once without any.
_MULTIPLIED = """SELECT taxpayer_id, ticker, cast(greatest(n, 1) * bonus_shares AS decimal(28,6)) AS quantidade,
    cast(greatest(n, 1) * bonus_value AS decimal(28,2)) AS valor_operacao, n * n_bonus AS pairs
    FROM (SELECT x.*, (SELECT count(*) FROM neg t WHERE t.taxpayer_id = x.taxpayer_id AND t.instrumento = x.ticker) AS n FROM extras x)
    WHERE n_bonus > 0"""


@_register("bonus_per_trade_v2", _bonus_parts_sql(_MULTIPLIED, "pairs"))
def _(d: Derived) -> DataFrame:
    return _exact(position.bonus_per_trade_v2(d.bonus(), d.trades()), *_BONUS_PARTS)


@_register(
    "avg_buy_price",
    f"SELECT taxpayer_id, instrumento, {amount('preco_u', 'preco_s')} AS preco_medio_compra FROM avg_by_row",
)
def _(d: Derived) -> DataFrame:
    return _exact(position.avg_buy_price(d.trades(), d.movements(), d.bonus()), "preco_medio_compra")


@_register("net_quantity", "SELECT * FROM net_qty")
def _(d: Derived) -> DataFrame:
    return position.net_quantity(d.trades(), d.movements(), d.bonus())


@_register(
    "year_end_dates",
    "SELECT taxpayer_id, max(data_pregao) FILTER (kind = 'custody') AS dt_custody, max(data_pregao) FILTER (kind = 'loan') AS dt_loans "
    "FROM (SELECT taxpayer_id, data_pregao, 'custody' AS kind FROM b3_posicao_acoes "
    "UNION ALL SELECT taxpayer_id, data_pregao, 'loan' FROM b3_posicao_emprestimos) GROUP BY taxpayer_id",
)
def _(d: Derived) -> DataFrame:
    return position.year_end_dates(d.custody(), d.loans())


@_register("year_end_custody", "SELECT * FROM ye_custody")
def _(d: Derived) -> DataFrame:
    return position.year_end_custody(d.custody())


@_register("year_end_loans", "SELECT * FROM ye_loans")
def _(d: Derived) -> DataFrame:
    return position.year_end_loans(d.loans())


@_register("year_end_position", "SELECT * FROM ye_position")
def _(d: Derived) -> DataFrame:
    return position.year_end_position(d.custody(), d.loans())


@_register("view_position", "SELECT * FROM vw_position")
def _(d: Derived) -> DataFrame:
    return _exact(view_position(d), *_PRICES)


def view_position(d: Derived) -> DataFrame:
    return position.view_position(d.trades(), d.movements(), d.bonus(), d.custody(), d.loans())


@_register("view_position_of_totals", "SELECT * FROM vw_position")
def _(d: Derived) -> DataFrame:
    # Totals of three parts of the tables, as three imports would leave them.
    folder = scratch_dir(d.spark, "totals")
    day = {"trades": "data_negocio", "movements": "data_pregao", "bonus": "data_pregao"}
    for part in range(3):
        tables = [getattr(d, name)().filter(F.month(column) % 3 == part) for name, column in day.items()]
        position.ticker_totals(*tables).write.mode("append").parquet(folder)
    totals = position.added_up(d.spark.read.parquet(folder))
    return _exact(position.position_of_totals(totals, d.custody(), d.loans()), *_PRICES)


_VALUED_SQL = f"""SELECT q.taxpayer_id, q.instrumento, {amount("q.preco_u", "q.preco_s")} AS preco_medio_compra, q.qtd_lado,
    {amount(f"(q.preco_u * {hugeint('q.qtd_lado', 6)})", "(q.preco_s + 6)")} AS posicao_fin, coalesce(lp.cnpj, '') AS cnpj,
    coalesce(lp.nome_compania, q.instrumento) AS nome_compania
    FROM priced q LEFT JOIN last_pos lp ON q.taxpayer_id = lp.taxpayer_id AND q.instrumento = lp.ticker WHERE q.qtd_lado > 0"""
_NET_V1 = """SELECT taxpayer_id, instrumento, cast(coalesce(sum(quantidade) FILTER (tipo_movimentacao = 'Compra'), 0) AS hugeint) AS bought,
    coalesce(sum(quantidade * preco) FILTER (tipo_movimentacao = 'Compra'), 0) AS cost,
    cast(sum(CASE tipo_movimentacao WHEN 'Compra' THEN quantidade WHEN 'Venda' THEN -quantidade ELSE 0 END) AS decimal(28,6)) AS qtd_lado
    FROM neg GROUP BY ALL"""


@_register(
    "view_position_v1",
    _VALUED_SQL,
    priced="SELECT * REPLACE (coalesce(preco_u, 0) AS preco_u, CASE WHEN preco_u IS NULL THEN 0 ELSE preco_s END AS preco_s) FROM ("
    + divided(_NET_V1, "preco", hugeint("cost", 6), "6", "bought", "0", "6")
    + ")",
)
def _(d: Derived) -> DataFrame:
    return _exact(position.view_position_v1(d.trades(), d.custody()), *_PRICES)


# Each trade gets its part of the multiplied bonus totals.
_WITH_MULTIPLIED = divided(
    divided(
        """SELECT s.*, m.quantidade AS many_shares, m.valor_operacao AS many_value, m.pairs, m.valor_operacao IS NOT NULL AS each_total,
        m.quantidade IS NOT NULL AS more_total FROM shared_out s
        LEFT JOIN multiplied m ON s.taxpayer_id = m.taxpayer_id AND s.instrumento = m.ticker""",
        "each",
        hugeint("many_value", 2, "decimal(28,2)"),
        "2",
        "cast(pairs AS hugeint)",
        "0",
        "2",
    ),
    "more",
    hugeint("many_shares", 6),
    "6",
    "cast(pairs AS hugeint)",
    "0",
    "6",
)


@_register(
    "view_position_v2",
    _VALUED_SQL,
    multiplied=_MULTIPLIED,
    bought=bought_price(_WITH_MULTIPLIED, value="each", gain="more"),
    priced="""SELECT b.*, (SELECT cast(
    sum(CASE tipo_movimentacao WHEN 'Compra' THEN quantidade ELSE -quantidade END) + coalesce(any_value(split_shares), 0)
    + coalesce(any_value((SELECT m.quantidade FROM multiplied m WHERE m.taxpayer_id = b.taxpayer_id AND m.ticker = b.instrumento)), 0)
    AS decimal(28,6)) FROM shared_out s WHERE s.taxpayer_id = b.taxpayer_id AND s.instrumento = b.instrumento) AS qtd_lado FROM bought b""",
)
def _(d: Derived) -> DataFrame:
    return _exact(position.view_position_v2(d.trades(), d.movements(), d.bonus(), d.custody()), *_PRICES)


@_register(
    "view_position_v3",
    _VALUED_SQL,
    priced="SELECT * FROM avg_by_row LEFT JOIN net_qty USING (taxpayer_id, instrumento)",
)
def _(d: Derived) -> DataFrame:
    return _exact(position.view_position_v3(d.trades(), d.movements(), d.bonus(), d.custody()), *_PRICES)


# --- Declaration ------------------------------------------------------------------------------


@once
def _income(d: Derived) -> DataFrame:
    return income.income(d.movements(), d.custody())


@once
def _bonus_income(d: Derived) -> DataFrame:
    return income.bonus_income(d.bonus(), d.custody())


@once
def _active(d: Derived) -> DataFrame:
    return declaration.active_tickers(d.custody(), d.loans())


@once
def _years(d: Derived) -> DataFrame:
    return declaration.declaration_years(_active(d), d.movements(), d.bonus())


@once
def _entries(d: Derived) -> DataFrame:
    rows = income.income_and_bonus(d.movements(), d.bonus(), d.custody())
    return income.declared_entries(rows, _active(d), _years(d))


@once
def _declared(d: Derived) -> DataFrame:
    held = position.position(d.trades(), d.movements(), d.bonus(), d.custody(), d.loans())
    return declaration.declared_positions(held, _active(d), REGISTRY)


@once
def _lines(d: Derived) -> DataFrame:
    return report.report_lines(_declared(d), _entries(d), _years(d), d.taxpayers(), registry=REGISTRY)


@_register("active_tickers", "SELECT * FROM active")
def _(d: Derived) -> DataFrame:
    return _active(d)


@_register("declared_positions", "SELECT * FROM declared")
def _(d: Derived) -> DataFrame:
    return _exact(_declared(d), *_PRICES)


@_register(
    "income_by_types",
    "SELECT * FROM vw_income WHERE movimentacao IN ('Dividendo', 'Dividendo - Transferido') AND ano_base = 1998",
)
def _(d: Derived) -> DataFrame:
    rows = income.income(d.movements(), d.custody(), year=1998)
    return income.income_of_types(rows, [DIVIDEND, DIVIDEND_TRANSFERRED])


def _section_sql(category: str) -> str:
    return f"SELECT * EXCLUDE (category) FROM entries WHERE category = '{category}'"


def _section(name: str, category: str, types: list[str]) -> None:
    @_register(name, _section_sql(category))
    def _(d: Derived) -> DataFrame:
        return income.section_events(_income(d), _active(d), types)


_section("sec_dividends", "exempt_dividend", [DIVIDEND, DIVIDEND_TRANSFERRED])
_section("sec_jcp", "taxable_jcp", [JCP, JCP_TRANSFERRED])
_section("sec_monetary_update", "taxable_monetary_update", [MONETARY_UPDATE])
_section("sec_fraction_auction", "exempt_fraction_auction", [FRACTION_AUCTION])


@_register("sec_bonus_shares", _section_sql("exempt_bonus_shares"))
def _(d: Derived) -> DataFrame:
    return income.section_bonus(_bonus_income(d), _active(d))


def _total_sql(kind: str) -> str:
    return f"""SELECT y.taxpayer_id, y.ano_base, cast(coalesce(sum(v.valor_operacao), 0) AS decimal(28,2)) AS valor_operacao
    FROM years y LEFT JOIN vw_income v ON y.taxpayer_id = v.taxpayer_id AND y.ano_base = v.ano_base AND v.movimentacao = '{kind}'
    GROUP BY 1, 2"""


@_register("sec_lending", _total_sql(LENDING))
def _(d: Derived) -> DataFrame:
    return income.section_total(_income(d), _years(d), LENDING)


@_register("sec_reimbursement", _total_sql(REIMBURSEMENT))
def _(d: Derived) -> DataFrame:
    return income.section_total(_income(d), _years(d), REIMBURSEMENT)


@_register("income_by_category", "SELECT * FROM by_category WHERE category <> 'exempt_bonus_shares'")
def _(d: Derived) -> DataFrame:
    return income.by_category(_income(d))


@_register(
    "format_tax_id",
    """SELECT id, codigo_negociacao, CASE WHEN cnpj IS NULL THEN '' ELSE concat(substr(p, 1, 2), '.', substr(p, 3, 3), '.',
    substr(p, 6, 3), '/', substr(p, 9, 4), '-', substr(p, 13)) END AS cnpj
    FROM (SELECT *, lpad(split_part(cnpj, '.', 1), 14, '0') AS p FROM b3_posicao_acoes)""",
)
def _(d: Derived) -> DataFrame:
    return d.custody().select("id", "codigo_negociacao", format_tax_id(F.col("cnpj")).alias("cnpj"))


@_register("resolve_tax_id", "SELECT taxpayer_id, ticker, resolved AS cnpj FROM tax_ids")
def _(d: Derived) -> DataFrame:
    return income.latest_position(d.custody()).select(
        TAXPAYER, "ticker", resolve_tax_id(F.col("ticker"), F.col("cnpj"), REGISTRY).alias("cnpj")
    )


@_register(
    "fmt_currency",
    f"SELECT taxpayer_id, instrumento, {cents('preco_medio_compra')} AS preco, concat('-', {cents('posicao_fin')}) AS negativo, "
    "cast(cast(qtd_lado AS bigint) AS string) AS inteiro FROM vw_position WHERE preco_medio_compra IS NOT NULL",
)
def _(d: Derived) -> DataFrame:
    held = view_position(d).filter("preco_medio_compra is not null")
    return held.select(
        TAXPAYER,
        "instrumento",
        format_amount(F.col("preco_medio_compra")).alias("preco"),
        format_amount(-F.col("posicao_fin")).alias("negativo"),
        format_amount(F.col("qtd_lado"), 0).alias("inteiro"),
    )


_WORDS = ReportText()
# A ticker's tax id where custody has one, else that of the registry of delisted companies.
_TAX_ID = """coalesce(CASE WHEN e.cnpj <> '' THEN t.resolved END, CASE e.ticker WHEN 'TK0003' THEN '12.345.678/0001-95'
      WHEN 'TK0103' THEN '98.765.432/0001-10' ELSE '' END)"""


def _said(*parts: str) -> str:
    """SQL text of wording and expressions; an expression stands in braces."""
    out = []
    for part in parts:
        expression = part.startswith("{") and part.endswith("}")
        out.append(part[1:-1] if expression else "'" + part.replace("'", "''") + "'")
    return f"concat({', '.join(out)})"


def _filled_sql(template: str, *values: str) -> list[str]:
    pieces = template.split("{}")
    shown = [f"{{{v}}}" for v in values[: len(pieces) - 1]]
    return [x for piece, value in zip(pieces, [*shown, ""], strict=True) for x in (piece, value) if x]


def _entry_sql(category: str) -> str:
    """Text lines of a category's entries: one per ticker, or one total of its kind per year."""
    words, section = _WORDS.entries[category], SECTION_OF_CATEGORY[category]
    kind = {TAXABLE_LENDING: LENDING, EXEMPT_REIMBURSEMENT: REIMBURSEMENT}.get(category)
    parts = [] if kind else [_WORDS.ticker_label, "{e.ticker}", "\n"]
    parts += [words.income_type_label, words.income_type, "\n", words.payer_tax_id_label]
    parts += [words.payer_tax_id or f"{{{_TAX_ID}}}", "\n", words.payer_name_label, words.payer_name or "{e.nome_compania}", "\n"]
    if words.description:
        parts += [words.description_label, *_filled_sql(words.description, "upper(e.ticker)"), "\n"]
    text = _said(*parts, words.amount_label, f"{{{money('e.valor_operacao')}}}", "\n\n")
    head = f"SELECT e.taxpayer_id, e.ano_base, {section} AS section, 1 AS place, {chr(39) * 2 if kind else 'e.ticker'} AS ticker, {text} AS text"
    if kind:
        return f"{head} FROM ({_total_sql(kind)}) e"
    return f"{head} FROM entries e LEFT JOIN tax_ids t ON e.taxpayer_id = t.taxpayer_id AND e.ticker = t.ticker WHERE e.category = '{category}'"


_TITLE_VALUES = ", ".join(f"({i}, {_said(title)})" for i, title in enumerate(_WORDS.titles))
_HEADER_SQL = f"""SELECT y.taxpayer_id, y.ano_base, 0 AS section, 1 AS place, '' AS ticker,
    {_said(_WORDS.full_name_label, "{coalesce(t.full_name, '')}", chr(10), _WORDS.cpf_label, "{coalesce(t.cpf, '')}", chr(10) * 2)} AS text
    FROM years y LEFT JOIN taxpayers t ON y.taxpayer_id = t.taxpayer_id"""
_POSITION_TEXT = _said(
    *[_WORDS.ticker_label, "{ticker}", "\n", _WORDS.group_label, _WORDS.group, "\n", _WORDS.code_label, _WORDS.code, "\n"],
    *[_WORDS.location_label, _WORDS.location, "\n", _WORDS.tax_id_label, "{cnpj}", "\n", _WORDS.description_label],
    *_filled_sql(_WORDS.description, "ticker", "cast(quantidade AS string)", cents("preco_medio_compra")),
    *["\n", _WORDS.traded_label, _WORDS.traded, "\n", _WORDS.trading_code_label, "{ticker}", "\n"],
    *_filled_sql(_WORDS.year_end_label, "concat('31/12/', cast(ano_base AS string))"),
    *[f"{{{cents('posicao_fin')}}}", "\n\n"],
)
_LINES_SQL = " UNION ALL ".join(
    [
        f"SELECT taxpayer_id, ano_base, section, 0 AS place, '' AS ticker, text FROM years CROSS JOIN (VALUES {_TITLE_VALUES}) t(section, text)",
        _HEADER_SQL,
        f"SELECT taxpayer_id, ano_base, 1, 1, ticker, {_POSITION_TEXT} FROM declared",
        *[_entry_sql(category) for category in SECTION_OF_CATEGORY],
    ]
)


@_register("contributor_header", "SELECT * FROM header", header=_HEADER_SQL)
def _(d: Derived) -> DataFrame:
    return report.contributor_header(_years(d), d.taxpayers(), _WORDS)


@_register("report_lines", "SELECT * FROM lines", lines=_LINES_SQL)
def _(d: Derived) -> DataFrame:
    return _lines(d)


@_register(
    "declaration_report",
    "SELECT taxpayer_id, ano_base, string_agg(text, '' ORDER BY section, place, ticker) AS report FROM lines GROUP BY 1, 2",
    lines=_LINES_SQL,
)
def _(d: Derived) -> DataFrame:
    return report.assemble_reports(_lines(d))


@_register(
    "report_texts",
    "SELECT taxpayer_id, ano_base, string_agg(text, '' ORDER BY section, place, ticker) AS report FROM lines GROUP BY 1, 2",
    lines=_LINES_SQL,
)
def _(d: Derived) -> DataFrame:
    folder = scratch_dir(d.spark, "texts")
    report.write_reports(_lines(d), folder)
    schema = "value string, taxpayer_id string, ano_base int"
    texts = d.spark.read.schema(schema).text(folder, wholetext=True)
    return texts.select(TAXPAYER, "ano_base", F.col("value").alias("report"))


@_register(
    "requested_base_year",
    "SELECT DISTINCT taxpayer_id, cast(extract(year FROM current_date) - 1 AS int) AS ano_base FROM taxpayers",
)
def _(d: Derived) -> DataFrame:
    return declaration.requested_year(d.taxpayers())


@once
def _nested(d: Derived) -> DataFrame:
    return declaration.nested_declaration(_declared(d), _entries(d), _years(d), REGISTRY)


@_register("declaration_nested")
def _(d: Derived) -> DataFrame:
    return _nested(d)


@_register(
    "declaration_nested_flat",
    """SELECT taxpayer_id, ano_base, list_name, ticker, cnpj, nome_compania, event_type, amount, price, value FROM years
    CROSS JOIN (VALUES ('positions'), ('exempt_dividends'), ('taxable_jcp'), ('taxable_monetary_update'), ('fraction_auction'),
    ('bonus_shares')) t(list_name) LEFT JOIN lists USING (taxpayer_id, ano_base, list_name)
    UNION ALL SELECT taxpayer_id, ano_base, 'lending_income', NULL, NULL, NULL, NULL, valor_operacao, NULL, NULL FROM ("""
    + _total_sql(LENDING)
    + """) UNION ALL SELECT taxpayer_id, ano_base, 'reimbursement', NULL, NULL, NULL, NULL, valor_operacao, NULL, NULL FROM ("""
    + _total_sql(REIMBURSEMENT)
    + ")",
    lists="""SELECT taxpayer_id, ano_base, 'positions' AS list_name, ticker, cnpj, nome_compania, '' AS event_type,
    cast(quantidade AS decimal(28,2)) AS amount, preco_medio_compra AS price, posicao_fin AS value FROM declared UNION ALL
    SELECT e.taxpayer_id, e.ano_base, CASE e.category WHEN 'exempt_dividend' THEN 'exempt_dividends' WHEN 'taxable_jcp' THEN 'taxable_jcp'
    WHEN 'taxable_monetary_update' THEN 'taxable_monetary_update' WHEN 'exempt_fraction_auction' THEN 'fraction_auction' ELSE 'bonus_shares' END,
    e.ticker, """
    + _TAX_ID
    + """, e.nome_compania, e.movimentacao, e.valor_operacao, NULL, NULL
    FROM entries e LEFT JOIN tax_ids t ON e.taxpayer_id = t.taxpayer_id AND e.ticker = t.ticker""",
)
def _(d: Derived) -> DataFrame:
    return _exact(declaration.flat_declaration(_nested(d)), "price", "value")


# --- Keyed records ----------------------------------------------------------------------------


def _records(d: Derived) -> DataFrame:
    """Events as stored records; those without a value have no payload."""
    event = F.col("event_type")
    return d.source("events").select(
        F.col("event_id").cast("string").alias("id"),
        F.when(event != "error", F.col("props")).alias("data"),
        "event_type",
    )


_RECORDS = "SELECT cast(event_id AS string) AS id, CASE WHEN event_type <> 'error' THEN props END AS data, event_type FROM events"


# Changes in the order of their number: click updates, view adds with ids, purchase adds without, error updates nothing.
# Every tenth view is updated before it is added, and again afterwards.
_CHANGES = """SELECT seq, op, id, data FROM (
    SELECT cast(id AS bigint) * 10 + 1 AS seq, 'update' AS op, id, concat('{"k": "u', id, '"}') AS data FROM recs WHERE event_type = 'click'
    UNION ALL SELECT cast(id AS bigint) * 10 + 2, 'add', concat('n', id), concat('{"k": "a', id, '"}') FROM recs WHERE event_type = 'view'
    UNION ALL SELECT cast(id AS bigint) * 10 + k, 'update', concat('n', id), concat('{"k": "v', id, '"}') FROM recs,
        (VALUES (1), (3)) t(k) WHERE event_type = 'view' AND cast(id AS bigint) % 10 = 0
    UNION ALL SELECT cast(id AS bigint) * 10 + 4, 'add', NULL, data FROM recs WHERE event_type = 'purchase'
    UNION ALL SELECT cast(id AS bigint) * 10 + 5, 'update', concat('unknown', id), concat('{"k": "u', id, '"}') FROM recs WHERE event_type = 'error')"""
_NEW_ID = "sha256(concat('batch:', cast(seq AS string)))"


def _changes(d: Derived) -> DataFrame:
    rows, event, number = _records(d), F.col("event_type"), F.col("id").cast("long") * 10

    def change(op: str, kind: str, id_prefix: str | None, mark: str | None, step: int) -> DataFrame:
        key = F.lit(None).cast("string") if id_prefix is None else F.concat(F.lit(id_prefix), F.col("id"))
        data = F.col("data") if mark is None else F.concat(F.lit('{"k": "' + mark), F.col("id"), F.lit('"}'))
        return rows.filter(event == kind).select(
            F.lit(op).alias("op"), key.alias("id"), data.alias("data"), (number + step).alias("seq")
        )

    again = [
        change(records.UPDATE, "view", "n", "v", step).filter(F.floor(F.col("seq") / 10) % 10 == 0) for step in (1, 3)
    ]
    parts = [
        change(records.UPDATE, "click", "", "u", 1),
        change(records.ADD, "view", "n", "a", 2),
        *again,
        change(records.ADD, "purchase", None, None, 4),
        change(records.UPDATE, "error", "unknown", "u", 5),
    ]
    return _union(parts)


_BATCH_TIME = datetime(2000, 1, 2, 3, 4, 5)


@_register(
    "records_upsert",
    f"""SELECT id, CASE WHEN event_type = 'click' THEN concat('{{"k": "u', id, '"}}') ELSE data END AS data,
        TIMESTAMP '1999-01-01' AS created_at,
        CASE WHEN event_type = 'click' THEN TIMESTAMP '2000-01-02 03:04:05' ELSE TIMESTAMP '1999-01-01' END AS updated_at FROM recs
    UNION ALL SELECT concat('n', id), concat(CASE WHEN cast(id AS bigint) % 10 = 0 THEN '{{"k": "v' ELSE '{{"k": "a' END, id, '"}}'),
        TIMESTAMP '2000-01-02 03:04:05', TIMESTAMP '2000-01-02 03:04:05' FROM recs WHERE event_type = 'view'
    UNION ALL SELECT {_NEW_ID}, data, TIMESTAMP '2000-01-02 03:04:05', TIMESTAMP '2000-01-02 03:04:05'
        FROM changes WHERE op = 'add' AND id IS NULL""",
    recs=_RECORDS,
    changes=_CHANGES,
)
def _(d: Derived) -> DataFrame:
    long_ago = F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz")
    old = _records(d).withColumns({"created_at": long_ago, "updated_at": long_ago})
    return records.upsert(old, _changes(d), "batch", F.lit(_BATCH_TIME).cast("timestamp_ntz"))


@_register(
    "records_upsert_results",
    f"""SELECT seq, op, coalesce(id, {_NEW_ID}) AS id, op = 'add' OR EXISTS (SELECT 1 FROM recs r WHERE r.id = c.id)
        OR EXISTS (SELECT 1 FROM changes a WHERE a.op = 'add' AND a.id = c.id AND a.seq < c.seq) AS hit FROM changes c""",
    recs=_RECORDS,
    changes=_CHANGES,
)
def _(d: Derived) -> DataFrame:
    return records.upsert_results(_records(d), _changes(d), "batch")


_WANTED = (
    "SELECT DISTINCT cast(user_id AS string) AS id FROM events UNION SELECT DISTINCT concat('x', cast(user_id AS string)) FROM events"
)


def _wanted(d: Derived) -> DataFrame:
    users = d.source("events").select(F.col("user_id").cast("string").alias("id"))
    return users.unionByName(users.select(F.concat(F.lit("x"), F.col("id")).alias("id")))


@_register(
    "records_lookup",
    """SELECT w.id, CASE WHEN r.id IS NOT NULL THEN coalesce(r.data, concat('{"id":"', r.id, '"}')) END AS data,
    r.id IS NOT NULL AS found FROM wanted w LEFT JOIN recs r ON w.id = r.id""",
    recs=_RECORDS,
    wanted=_WANTED,
)
def _(d: Derived) -> DataFrame:
    return records.lookup(_records(d), _wanted(d))


@_register(
    "records_delete",
    "SELECT id, data FROM recs WHERE id NOT IN (SELECT id FROM wanted)",
    recs=_RECORDS,
    wanted=_WANTED,
)
def _(d: Derived) -> DataFrame:
    return records.delete(_records(d).select("id", "data"), _wanted(d))


@_register(
    "records_delete_results",
    "SELECT w.id, r.id IS NOT NULL AS deleted FROM wanted w LEFT JOIN recs r ON w.id = r.id",
    recs=_RECORDS,
    wanted=_WANTED,
)
def _(d: Derived) -> DataFrame:
    return records.deletion_results(_records(d), _wanted(d))


# Payloads of several shapes: all have k, some a nested object, a text in place of k, or a null.
_SHAPES = """SELECT id, CASE WHEN cast(id AS bigint) % 11 = 0 THEN '[1,2]' WHEN cast(id AS bigint) % 7 = 0 THEN '{"k":"none","x":1}'
    ELSE concat('{"at":["', event_type, '",null],"k":', json_extract_string(data, '$.k'),
      CASE WHEN cast(id AS bigint) % 3 = 0 THEN concat(',"user":{"id":', id, ',"tags":[]}') ELSE '' END, '}') END AS data
    FROM recs WHERE data IS NOT NULL UNION ALL SELECT id, NULL FROM recs WHERE data IS NULL"""


def _shapes(d: Derived) -> DataFrame:
    number = F.col("id").cast("bigint")
    nested = F.when(number % 3 == 0, F.concat(F.lit(',"user":{"id":'), "id", F.lit(',"tags":[]}'))).otherwise("")
    k = F.get_json_object("data", "$.k")
    plain = F.concat(F.lit('{"at":["'), "event_type", F.lit('",null],"k":'), k, nested, F.lit("}"))
    shaped = F.when(number % 11 == 0, "[1,2]").when(number % 7 == 0, '{"k":"none","x":1}').otherwise(plain)
    return _records(d).select("id", F.when(F.col("data").isNotNull(), shaped).alias("data"))


@_register(
    "records_decode",
    """SELECT id, try_cast(json_extract_string(data, '$.k') AS int) AS k,
    CASE WHEN data IS NULL THEN concat('{"id":"', id, '"}') WHEN data LIKE '[%' THEN data ELSE (
      SELECT concat('{', string_agg(concat('"', f.key, '":', f.value), ',' ORDER BY f.key), '}') FROM json_each(data) f
      WHERE f.key <> 'k' OR f.type = 'VARCHAR') END AS others FROM shapes""",
    recs=_RECORDS,
    shapes=_SHAPES,
)
def _(d: Derived) -> DataFrame:
    decoded = records.decode(_shapes(d), "k int")
    return decoded.withColumn("others", F.to_json("others"))


@_register(
    "records_field_values",
    """SELECT s.id, f.key, CASE WHEN f.type = 'VARCHAR' THEN 'STRING' WHEN f.type IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE f.type END AS type,
      cast(f.value AS varchar) AS value FROM shapes s, json_each(s.data) f WHERE s.data NOT LIKE '[%'
    UNION ALL SELECT id, NULL, 'ARRAY', data FROM shapes WHERE data LIKE '[%'
    UNION ALL SELECT id, 'id', 'STRING', concat('"', id, '"') FROM shapes WHERE data IS NULL""",
    recs=_RECORDS,
    shapes=_SHAPES,
)
def _(d: Derived) -> DataFrame:
    return records.field_values(_shapes(d))
