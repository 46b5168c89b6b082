"""Values that come from the exchange's reports and the tax form and cannot be chosen freely."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# ---------------------------------------------------------------------------
# Movement types as printed in the exchange's movement report.
# ---------------------------------------------------------------------------
DIVIDEND = "Dividendo"
DIVIDEND_TRANSFERRED = "Dividendo - Transferido"
JCP = "Juros Sobre Capital Próprio"
JCP_TRANSFERRED = "Juros Sobre Capital Próprio - Transferido"
MONETARY_UPDATE = "Rendimento"
FRACTION_AUCTION = "Leilão de Fração"
LENDING = "Empréstimo"
REIMBURSEMENT = "Reembolso"
SPLIT = "Desdobro"
BONUS = "Bonificação em Ativos"

CREDIT = "Credito"
BUY = "Compra"
SELL = "Venda"

INCOME_TYPES = (
    MONETARY_UPDATE,
    LENDING,
    FRACTION_AUCTION,
    DIVIDEND,
    DIVIDEND_TRANSFERRED,
    JCP,
    JCP_TRANSFERRED,
    REIMBURSEMENT,
)

# Tax categories and the movement types that belong to them.
EXEMPT_DIVIDEND = "exempt_dividend"
TAXABLE_JCP = "taxable_jcp"
TAXABLE_MONETARY_UPDATE = "taxable_monetary_update"
TAXABLE_LENDING = "taxable_lending"
EXEMPT_REIMBURSEMENT = "exempt_reimbursement"
EXEMPT_FRACTION_AUCTION = "exempt_fraction_auction"
EXEMPT_BONUS_SHARES = "exempt_bonus_shares"

CATEGORY_OF_TYPE = {
    DIVIDEND: EXEMPT_DIVIDEND,
    DIVIDEND_TRANSFERRED: EXEMPT_DIVIDEND,
    JCP: TAXABLE_JCP,
    JCP_TRANSFERRED: TAXABLE_JCP,
    MONETARY_UPDATE: TAXABLE_MONETARY_UPDATE,
    LENDING: TAXABLE_LENDING,
    REIMBURSEMENT: EXEMPT_REIMBURSEMENT,
    FRACTION_AUCTION: EXEMPT_FRACTION_AUCTION,
    BONUS: EXEMPT_BONUS_SHARES,
}
# These two are one amount per taxpayer and year, whatever the ticker.
SCALAR_CATEGORIES = (TAXABLE_LENDING, EXEMPT_REIMBURSEMENT)

# Sheet of the annual report that feeds each table.
ANNUAL_SHEETS = {
    "Posição - Ações": "b3_posicao_acoes",
    "Posição - Empréstimos": "b3_posicao_emprestimos",
    "Proventos Recebidos": "b3_proventos_recebidos",
    "Reembolsos de Empréstimo": "b3_reembolso_emprestimos",
}

# Table names of an older database and their present names.
LEGACY_TABLES = {
    "bonificacao_acoes": "b3_bonificacao_acoes",
    "movimentacao": "b3_movimentacao",
    "negociacao": "b3_negociacao",
    "posicao_acoes": "b3_posicao_acoes",
    "posicao_emprestimos": "b3_posicao_emprestimos",
    "proventos_recebidos": "b3_proventos_recebidos",
    "reembolso_emprestimos": "b3_reembolso_emprestimos",
}

# Tax ids of companies that the exchange's report leaves blank.
DELISTED_TAX_IDS = {
    "CPFE3": "02.429.144/0001-93",
    "BBSE3": "17.344.597/0001-94",
    "KLBN11": "89.637.490/0001-45",
    "SANB11": "90.400.888/0001-42",
    "SAPR11": "76.484.013/0001-45",
    "TAEE11": "07.859.971/0001-30",
}

# Cell conventions of the exchange's workbooks.
DASH = "-"
MISSING_CELLS = (DASH, "", " ")
MAX_MISSING_CELLS = 3
NO_DATE = date(2100, 1, 1)
SHEET_DATE_FORMAT = "dd/MM/yyyy"
PRODUCT_SEPARATOR = " - "

# Markup of a corporate-action card on a stored company page.
CARD_CLASS = "card p-2 p-xs-3"
CARD_VALUE_CLASS = "d-block lh-3 fs-3 fw-700"
CARD_TITLE_WORD = "bonifica"
CARD_FIELDS = (
    "data_anuncio",
    "data_com",
    "data_ex",
    "data_incorporacao",
    "valor_base",
    "proporcao",
)


# Wording of the declaration text.
@dataclass(frozen=True)
class EntryText:
    """Labels of one income section; payer fields are set where the payer is always the same."""

    income_type: str
    payer_tax_id: str | None = None
    payer_name: str | None = None
    description: str | None = None
    income_type_label: str = "Tipo de Rendimento: "
    payer_tax_id_label: str = "CNPJ da Fonte Pagadora: "
    payer_name_label: str = "Nome da Fonte Pagadora: "
    description_label: str = "Descrição: "
    amount_label: str = "Valor: "


@dataclass(frozen=True)
class ReportText:
    """Titles and labels of the report; replace fields to reword it. ``{}`` takes a value."""

    titles: tuple[str, ...] = (
        "**************** 0. DADOS DO CONTRIBUINTE ****************\n\n",
        "**************** 1. BENS E DIREITOS ****************\n\n",
        "\n\n**************** 2. DIVIDENDOS - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS"
        " ****************\n\n",
        "\n\n**************** 3. JCP - RENDIMENTOS SUJEITOS À TRIBUTAÇÃO EXCLUSIVA/DEFINITVA"
        " *****************\n\n",
        "\n\n**************** 4. LEILÃO DE FRAÇÃO DE AÇÕES - RENDIMENTOS ISENTOS E NÃO"
        " TRIBUTÁVEIS ****************\n\n",
        "\n\n**************** 5. BONIFICAÇÃO EM AÇÕES - RENDIMENTOS ISENTOS E NÃO TRIBUTÁVEIS"
        " ****************\n\n",
        "\n\n**************** 6. RENDIMENTOS DE ATUALIZAÇÕES DE BASES MONETÁRIAS -"
        " RENDIMENTOS SUJEITOS À TRIBUTAÇÃO EXCLUSIVA/DEFINITVA ****************\n\n",
        "\n\n**************** 7. RENDIMENTOS COM ALUGUEL DE AÇÕES  - RENDIMENTOS SUJEITOS À"
        " TRIBUTAÇÃO EXCLUSIVA / DEFINITIVA****************\n\n",
        "\n\n**************** 8. RENDIMENTOS COM REEMBOLSO DE PROVENTOS  - RENDIMENTOS ISENTOS"
        " E NÃO TRIBUTÁVEIS ****************\n\n",
    )
    decimal_places: int = 2
    full_name_label: str = "Nome Completo Contribuinte: "
    cpf_label: str = "CPF Contribuinte: "
    ticker_label: str = "\\\\ TICKER: "
    group_label: str = "Grupo: "
    group: str = "03 - Participações Societárias"
    code_label: str = "Código: "
    code: str = "01 - Ações (inclusive as listadas em bolsa)"
    location_label: str = "Localização (País): "
    location: str = "105 - Brasil"
    tax_id_label: str = "CNPJ: "
    description_label: str = "Discriminação: "
    description: str = "{} {} QUANTIDADES, ADQUIRIDAS A UM PRECO MEDIO DE R$ {}"
    traded_label: str = "Negociados em Bolsa? "
    traded: str = "Sim"
    trading_code_label: str = "Código de Negociação: "
    year_end_label: str = "Situação em {} (R$): "
    entries: dict[str, EntryText] = field(
        default_factory=lambda: {
            EXEMPT_DIVIDEND: EntryText("09 - Lucros e dividendos recebidos"),
            TAXABLE_JCP: EntryText("10 - Juros sobre capital próprio"),
            EXEMPT_FRACTION_AUCTION: EntryText(
                "99 - Outros", description="VENDA DE FRACAO DE ACAO EM LEILAO - {}"
            ),
            EXEMPT_BONUS_SHARES: EntryText(
                "18 - Incorporação de reservas ao capital / Bonficações em ações"
            ),
            TAXABLE_MONETARY_UPDATE: EntryText("06 - Rendimentos de aplicações financeiras"),
            TAXABLE_LENDING: EntryText(
                "06 - Rendimentos de aplicações financeiras",
                payer_tax_id="09.346.601/0001-25",
                payer_name="B3 S.A. - BRASIL. BOLSA. BALCAO",
            ),
            EXEMPT_REIMBURSEMENT: EntryText(
                "99 - Outros",
                payer_tax_id="09.346.601/0001-25",
                payer_name="B3 S.A. - BRASIL. BOLSA. BALCAO",
                description="REEMBOLSO DE PROVENTOS REFERENTES A ACOES ALUGADAS",
            ),
        }
    )


# Order of the report's sections.
SECTION_CONTRIBUTOR = 0
SECTION_POSITIONS = 1
SECTION_OF_CATEGORY = {
    EXEMPT_DIVIDEND: 2,
    TAXABLE_JCP: 3,
    EXEMPT_FRACTION_AUCTION: 4,
    EXEMPT_BONUS_SHARES: 5,
    TAXABLE_MONETARY_UPDATE: 6,
    TAXABLE_LENDING: 7,
    EXEMPT_REIMBURSEMENT: 8,
}
