"""Table schemas: column order is the order of the columns in the exchange's sheets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)
MONEY = T.DecimalType(18, 2)
COUNT = T.DecimalType(18, 0)
RATE = T.DecimalType(10, 6)
# Sums are kept wider than the columns they add up, so that a very large group cannot overflow.
QUANTITY_SUM = T.DecimalType(28, 6)
MONEY_SUM = T.DecimalType(28, 2)
COUNT_SUM = T.DecimalType(28, 0)

TAXPAYER = "taxpayer_id"

MOVEMENTS = "movimentacao"
TRADES = "negociacao"
ANNUAL = "relatorio-consolidado-anual"


@dataclass(frozen=True)
class TableSpec:
    """One imported table: its report, its typed sheet columns and the key that decides repeats."""

    name: str
    report: str
    columns: tuple[tuple[str, T.DataType], ...]
    id_column: str
    natural_key: tuple[str, ...]

    @property
    def annual(self) -> bool:
        return self.report == ANNUAL

    @property
    def date_column(self) -> str:
        """The date that is part of every row's key."""
        return "data_negocio" if self.report == TRADES else "data_pregao"

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def key(self) -> list[str]:
        return [TAXPAYER, *self.natural_key]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(TAXPAYER, T.StringType()), T.StructField(self.id_column, T.StringType())]
        return T.StructType(fields + [T.StructField(n, t) for n, t in self.columns])


_MOVEMENT_COLUMNS = (
    ("entrada_saida", T.StringType()),
    ("data_pregao", T.DateType()),
    ("movimentacao", T.StringType()),
    ("produto", T.StringType()),
    ("instituicao", T.StringType()),
    ("quantidade", PRICE),
    ("preco_unitario", PRICE),
    ("valor_operacao", MONEY),
)
_EVENT_COLUMNS = (
    ("produto", T.StringType()),
    ("tipo_evento", T.StringType()),
    ("valor_liquido", MONEY),
    ("data_pregao", T.DateType()),
)
_EVENT_KEY = ("produto", "tipo_evento", "data_pregao")

_SPECS = (
    TableSpec("b3_movimentacao", MOVEMENTS, _MOVEMENT_COLUMNS, "pk_movimentacao", ("pk_movimentacao",)),
    TableSpec(
        "b3_negociacao",
        TRADES,
        (
            ("data_negocio", T.DateType()),
            ("tipo_movimentacao", T.StringType()),
            ("mercado", T.StringType()),
            ("prazo_vencimento", T.DateType()),
            ("instituicao", T.StringType()),
            ("ticker", T.StringType()),
            ("quantidade", T.IntegerType()),
            ("preco", PRICE),
            ("valor", MONEY),
        ),
        "pk_negociacao",
        ("pk_negociacao",),
    ),
    TableSpec(
        "b3_posicao_acoes",
        ANNUAL,
        (
            ("produto", T.StringType()),
            ("instituicao", T.StringType()),
            ("conta", COUNT),
            ("codigo_negociacao", T.StringType()),
            ("cnpj", T.StringType()),
            ("codigo_isin", T.StringType()),
            ("tipo", T.StringType()),
            ("escriturador", T.StringType()),
            ("quantidade", COUNT),
            ("quantidade_disp", COUNT),
            ("quantidade_indisp", COUNT),
            ("motivo", T.StringType()),
            ("preco_fechamento", PRICE),
            ("valor_atualizado", MONEY),
            ("data_pregao", T.DateType()),
        ),
        "id",
        ("codigo_negociacao", "data_pregao", "instituicao", "conta"),
    ),
    TableSpec(
        "b3_posicao_emprestimos",
        ANNUAL,
        (
            ("produto", T.StringType()),
            ("instituicao", T.StringType()),
            ("natureza", T.StringType()),
            ("num_contrato", T.StringType()),
            ("modalidade", T.StringType()),
            ("opa", T.StringType()),
            ("liquidacao_antecipada", T.StringType()),
            ("taxa", RATE),
            ("comissao", RATE),
            ("data_registro", T.DateType()),
            ("data_vencimento", T.DateType()),
            ("quantidade", COUNT),
            ("preco_fechamento", PRICE),
            ("valor_atualizado", MONEY),
            ("data_pregao", T.DateType()),
        ),
        "id",
        ("num_contrato", "data_pregao"),
    ),
    TableSpec("b3_proventos_recebidos", ANNUAL, _EVENT_COLUMNS, "id", _EVENT_KEY),
    TableSpec("b3_reembolso_emprestimos", ANNUAL, _EVENT_COLUMNS, "id", _EVENT_KEY),
    TableSpec("b3_bonificacao_acoes", MOVEMENTS, _MOVEMENT_COLUMNS, "pk_movimentacao", ("pk_movimentacao",)),
)

# Import order: bonus rows are built from movements and come last.
TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


def table_spec(name: str) -> TableSpec:
    """Spec of a table; an unknown name is an error."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return TABLES[name]
