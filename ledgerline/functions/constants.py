"""Fixed values.

These literals must equal the ones the loaded sales tables already hold
(sentinels, month names, normalisation lists).  They are stated once here,
plainly and in their natural order; everything else takes them from here.
"""

# --- fixed values: sentinels written into loaded rows -------------------
NOT_RECORDED = "NO REGISTRA"          # text fill for absent values
NOT_RECORDED_CODE = "NR"              # code fill for absent codes
NOT_APPLICABLE = "NO APLICA"          # org-chart / label fill
UNASSIGNED = "SIN ASIGNACION"         # fill-from-other-column default
OTHERS = "OTROS"                      # bucket for unassigned spellings
PENDING_STATE = "PENDIENTE_ESTADO"    # consultant state when unknown
INACTIVE = "INACTIVO"                 # consultant state for vacancies
CROSS_SELLING = "CROSS SELLING"       # recode of category 'A'
VACANCY_MARKER = "(VACANTE)"          # vacancy marker inside names
VACANCY_DOCUMENT = "11"               # document number used for vacancies
UNKNOWN_DOCUMENT = "1234"             # document number used for unknowns
SENTINEL_DATE = "1900-01-01"          # null date fill
SENTINEL_TIME_BASE = "1899-12-30"     # null time-of-day fill; Excel day 0
INT32_MAX = 2147483647
INT32_MIN = -2147483648

# Lifecycle states of loaded rows and runs.
STATE_ACTIVE = 1
STATE_ERROR = 2
STATE_INACTIVE = 4

# --- fixed values: Spanish month names, January .. December -------------
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
MONTH_ABBREVIATIONS = [
    "ENE", "FEB", "MAR", "ABR", "MAY", "JUN",
    "JUL", "AGO", "SEP", "OCT", "NOV", "DIC",
]

# --- fixed values: spellings normalised to OTROS (fixed-line sales) -----
UNASSIGNED_SPELLINGS = [
    "NO APLICA", "NO REGISTRA", "OTRO", "OTRA",
    "SIN ASIGNACION", "SIN ASIGNACIÓN", "SIN ASIGNACÍON",
    "SIN ASIGNAción", "SIN ASIGNACI�N", "SIN ASIGNACI�@N",
    "SIN ASIGNACIÓN\n", "SIN ASIGNACION\n", "SIN ASIGNACI�N\n",
    "SIN ASIGNACI?N", "SIN ASIGNACI?N\n", "SIN ASIGNACIￜN",
    "SIN ASIGNACIñN", "SIN ASIGNACIï¿œN",
    "SIN ASIGNACI”N",
]
MANAGER_UNASSIGNED = ["SIN ASIGNACION", "VENTAS SIN ASIGNAR", "NO APLICA"]

# --- fixed values: replacement-character repair (fixed-line sales) -----
MOJIBAKE_REPAIRS = {"�": "ñ"}

# --- fixed values: special characters removed by the transfers clean ---
SPECIAL_CHARS_CLASS = "[|.*}$@]"
