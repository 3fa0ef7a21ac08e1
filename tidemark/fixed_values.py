"""Values that results depend on word for word."""

# --- Fixed values: words read as booleans (compared in lower case, not trimmed) ---
TRUE_WORDS = ["t", "true", "1", "y", "yes", "v", "verdadero", "si"]
FALSE_WORDS = ["f", "false", "0", "n", "no", "falso"]

# --- Fixed values: weekday names, Monday first ---
WEEKDAY_NAMES = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]

# --- Fixed values: e-mail pattern; word characters are Unicode, hence (?U) in Java ---
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"

# --- Fixed values: quality report ---
REPORT_OK = "OK"
REPORT_FAILED = "FALLA"
REPORT_TOTAL = "Total Registros"
NULL_SHARE_LIMIT = 95.0
MINIMUM_AGE = 18
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- Fixed values: detail texts of the quality report ---
TEXT_NULLS = "valores nulos"
TEXT_NEGATIVE = "valores negativos"
TEXT_EMAIL = "correos inválidos"
TEXT_DUPLICATES = "duplicados encontrados"
TEXT_BOOLEAN = "Columna '{}' es tipo booleano."
TEXT_NOT_BOOLEAN = "Valores no corresponden a booleanos"
TEXT_DATE_TYPE = "Columna '{}' ya es tipo {}"
TEXT_DATE_FROM_NUMBER = "Columna '{}' convertida desde timestamp numérico"
TEXT_DATE_FROM_TEXT = "Columna '{}' convertida desde string"
TEXT_NO_DATE_TYPE = "Tipo no compatible para fecha: {}"
TEXT_FUTURE = "registros con fecha futura"
TEXT_AGE = "registros con edad menor a {}"
TEXT_NULL_SHARE = "% de nulos en la columna"
TEXT_NO_COLUMN = "Columna no encontrada"
TEXT_NO_RULE = "Regla '{}' no reconocida"
TEXT_TOTAL = "de registros"

# --- Fixed values: fillers for missing attributes ---
CAMPAIGN_FILLERS = {"total_count": 0, "subject_length": 0, "channel": "unknow", "topic": "unknow"}
MESSAGE_FILLERS = {"platform": "unknow", "email_provider": "unknow"}
CLIENT_FILLERS = {
    "age": 18,
    "churn_risk": 0.0,
    "average_purchase_value": 0.0,
    "gender": "other",
    "country": "Colombia",
    "city": "Bogotá",
    "preferred_channel": "unknow",
    "loyalty_level": "unsubscribed",
}

# --- Fixed values: accepted values of the database enums ---
CAMPAIGN_CHANNELS = ["mobile_push", "email", "whatsapp", "dashboard"]
GENDERS = ["female", "male", "other"]
