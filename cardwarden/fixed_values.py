"""Values fixed by the data contract: changing one changes the results."""

# fixed values: texts that stand for something missing
NOT_INFORMED = "NAO INFORMADO"
CODE_UNKNOWN = "00000"
AGENCY_UNKNOWN = "OUTROS / NAO IDENTIFICADO"
POWER_DEFAULT = "EXECUTIVO"
CARD_TYPE_ID_DEFAULT = 1
CARD_TYPE_NORMALISED = "CPGF - Cartão de Pagamento do Governo Federal"
CARD_TYPE_STAGED = "CPGF - CARTAO DE PAGAMENTO"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# fixed values: document patterns cut out of names, in the order they are applied.
# BLANKS and SPACE are the blanks of the source contract; (?U) makes \d and \s Unicode-aware.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       "
    "         　"
)
SPACE = r"[\s\x1c-\x1f]"
NAME_PATTERNS = [
    rf"(?U)^\d{{2}}\.\d{{3}}\.\d{{3}}(/\d{{4}}-\d{{2}})?{SPACE}*[-–]?{SPACE}*",
    rf"(?U)^\d{{14}}{SPACE}*[-–]?{SPACE}*",
    rf"(?iU){SPACE}*[-–]?{SPACE}*(CPF|CNPJ)[:\s\x1c-\x1f]*[\d\.\-\*\/]+$",
    rf"(?U){SPACE}+\d{{11}}$",
    rf"(?U){SPACE}+\d{{14}}$",
]

# fixed values: periods and calendar
DEFAULT_YEAR = 2026
MONTHS_BACK = 2
MONTH_CUTOFF = "2024-01"
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2026-12-31"
UNKNOWN_DATE = "1900-01-01"
UNKNOWN_DATE_KEY = 19000101
UNKNOWN_MONTH = "1900-00"
UNKNOWN_LABEL = "Desconhecido"
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]

# fixed values: alert levels (order, level, reason) and their thresholds
ALERT_LEVELS = [
    (1, "NORMAL", "Transacao dentro da variacao esperada"),
    (2, "MODERADO", "Gasto moderadamente acima da media do orgao (> 1.8 sigma ou > R$ 15k)"),
    (3, "CRITICO",
     "Gasto significativamente acima do desvio padrao do orgao (> 2.5 sigma ou > R$ 40k)"),
]
CRITICAL_Z, CRITICAL_AMOUNT = 2.5, 40000
MODERATE_Z, MODERATE_AMOUNT = 1.8, 15000

# fixed values: anomaly model and the texts that explain a flag
MODEL_VERSION = "isolation_forest_v1_cpgf"
FOREST_TREES = 150
FOREST_SAMPLE = 256
FOREST_SEED = 42
EXPLAIN_Z = 2.0
EXPLAIN_RARE_SUPPLIER = 2
EXPLAIN_RARE_AMOUNT = 1000
REASON_WEEKEND = "Transação em fim de semana"
REASON_Z = "Alto desvio da média do órgão"
REASON_RARE = "Fornecedor esporádico com valor alto"
REASON_P99 = "Anomalia severa multivariada"
REASON_P95 = "Transação com padrão atípico moderado"
REASON_NONE = "Padrão regular"
FEATURES = [
    "vl_transacao", "z_score", "razao_media_orgao", "dia_semana",
    "fl_fim_semana", "freq_favorecido", "freq_portador",
]
