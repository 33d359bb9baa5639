"""Fixed values the results depend on.

FIXED VALUES: these strings must stay exactly as written for results to
match the registry's published behaviour (state list, patterns, defaults).
They are stated plainly, in natural order.
"""

# FIXED VALUES — the 27 Brazilian states as "UF - Name" labels, in list order.
STATE_LABELS = [
    "AC - Acre", "AL - Alagoas", "AP - Amapá", "AM - Amazonas", "BA - Bahia", "CE - Ceará",
    "DF - Distrito Federal", "ES - Espírito Santo", "GO - Goiás", "MA - Maranhão", "MT - Mato Grosso",
    "MS - Mato Grosso do Sul", "MG - Minas Gerais", "PR - Paraná", "PB - Paraíba", "PA - Pará",
    "PE - Pernambuco", "PI - Piauí", "RN - Rio Grande do Norte", "RS - Rio Grande do Sul",
    "RJ - Rio de Janeiro", "RO - Rondônia", "RR - Roraima", "SC - Santa Catarina", "SE - Sergipe",
    "SP - São Paulo", "TO - Tocantins",
]

# FIXED VALUES — target columns of the registry table and their limits.
KEY = "codigo_incra"
DATA_COLUMNS = ["codigo_incra", "matricula", "municipio", "denominacao", "proprietario", "pct_obtencao"]
TABLE_COLUMNS = DATA_COLUMNS + ["uf"]
MATRICULA_MAX_LEN = 20
UF_MAX_LEN = 2
PCT_PRECISION, PCT_SCALE = 12, 4

# FIXED VALUES — patterns. CPF: tax number with optional separators; owner split: ";", "|",
# " / " and the word "e", matched case-insensitively; lookup key: the path-parameter charset.
CPF_PATTERN = r"(\d{3})\.?\s*(\d{3})\.?\s*(\d{3})\-?(\d{2})"
OWNER_SPLIT_PATTERN = r"\s*(?:;|\||\s/\s|\s+e\s+)\s*"
LOOKUP_KEY_PATTERN = r"^[A-Za-z0-9./_-]+$"

# Java forms of the patterns above: (?U) gives \d and \s Python's Unicode meaning, (?i) the
# case-insensitive split; \z instead of $ because Java's $ also matches before a final newline.
CPF_REGEX = "(?U)" + CPF_PATTERN
OWNER_SPLIT_REGEX = "(?iU)" + OWNER_SPLIT_PATTERN
LOOKUP_KEY_REGEX = LOOKUP_KEY_PATTERN[:-1] + r"\z"
LOOKUP_KEY_MAX_LEN = 64
NAME_STRIP_CHARS = " -:\t"
CPF_MASK_PREFIX = "***.***.***-"
CPF_MASK_UNKNOWN = "***.***.***-**"
CPF_MASK_CONTRACT = r"^\*\*\*\.\*\*\*\.\*\*\*-(\d{2}|\*\*)$"

# FIXED VALUES — defaults of the lookup record.
NOT_INFORMED = "Nao informado"
OWNER_LINK = "Proprietario"
PCT_DEFAULT = 100.0
PCT_MIN, PCT_MAX = 0.0, 100.0

# FIXED VALUES — texts treated as "no number" by the loader (compared lower-cased after strip).
NULL_NUMBER_TEXTS = ["", "none", "null"]

# FIXED VALUES — placeholder option text on the portal's state list.
PLACEHOLDER_OPTION = "Selecione"
LABEL_SEPARATOR = " - "
