"""Declared table schemas and the fixed domain values.

Everything under "FIXED VALUES" must stay exactly as written: codes, reason
texts, bucket names and premiums are what downstream users of the data see.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published behaviour of the data product)
# ---------------------------------------------------------------------------

CUSTOMER_TYPES = ("PF", "PJ")
ALLOWED_CUSTOMER_TYPES = ("PF", "PJ", "PF/PJ")
ANY_CUSTOMER_TYPE = "PF/PJ"
RISK_RATINGS = ("A", "B", "C", "D", "E")
VALID_CONTRACT_STATUSES = ("ACTIVE", "CLOSED")
PAYMENT_EVENT_TYPE = "PAYMENT"
PII_COLUMNS = ("customer_name", "document_id", "email")

# Risk premium added to a product's base rate, by rating; other ratings get 0.100.
RISK_PREMIUMS = {"A": Decimal("0.000"), "B": Decimal("0.015"), "C": Decimal("0.035"),
                 "D": Decimal("0.065")}
DEFAULT_RISK_PREMIUM = Decimal("0.100")

# Contract rules, in array order: (code, reason).
CONTRACT_RULE_TEXTS = [
    ("DUPLICATE_CONTRACT_ID", "Outro registro foi priorizado para o mesmo contrato"),
    ("INVALID_CONTRACT_ID", "Identificador de contrato inválido"),
    ("NULL_CUSTOMER_ID", "Cliente obrigatório"),
    ("CUSTOMER_NOT_FOUND", "Cliente não encontrado"),
    ("NULL_PRODUCT_ID", "Produto obrigatório"),
    ("PRODUCT_NOT_FOUND", "Produto não encontrado"),
    ("INVALID_PRINCIPAL_AMOUNT", "Valor principal deve ser positivo"),
    ("INVALID_INTEREST_RATE", "Taxa anual fora do intervalo decimal válido"),
    ("INVALID_TERM", "Prazo inválido"),
    ("TERM_EXCEEDS_PRODUCT_LIMIT", "Prazo supera o limite do produto"),
    ("CUSTOMER_TYPE_NOT_ALLOWED", "Tipo de cliente incompatível com o produto"),
    ("INVALID_CONTRACT_STATUS", "Status contratual desconhecido"),
    ("INVALID_CONTRACT_DATE", "Data contratual inválida"),
]

# Payment rules, in array order: (code, reason).
PAYMENT_RULE_TEXTS = [
    ("DUPLICATE_PAYMENT_ID", "Outro evento foi priorizado para o mesmo pagamento"),
    ("INVALID_PAYMENT_ID", "Identificador de pagamento inválido"),
    ("NULL_INSTALLMENT_ID", "Parcela obrigatória"),
    ("INSTALLMENT_NOT_FOUND", "Parcela não encontrada"),
    ("CONTRACT_MISMATCH", "Contrato diverge da parcela"),
    ("INSTALLMENT_NUMBER_MISMATCH", "Número da parcela divergente"),
    ("INVALID_PAYMENT_AMOUNT", "Valor pago deve ser positivo"),
    ("INVALID_PAYMENT_DATE", "Data de pagamento obrigatória"),
    ("INVALID_EVENT_TIMESTAMP", "Timestamp do evento obrigatório"),
    ("INVALID_EVENT_TYPE", "Tipo de evento inválido"),
    ("RESCUED_SOURCE_DATA", "Existem campos não compatíveis com o contrato de schema"),
]

# Installment statuses and contract delinquency buckets.
PAID, OVERDUE, PARTIALLY_PAID, OPEN = "PAID", "OVERDUE", "PARTIALLY_PAID", "OPEN"
PAID_TOLERANCE = Decimal("0.01")
# (upper bound of max days past due, bucket); above the last bound: DPD_90_PLUS
DELINQUENCY_BUCKETS = [(0, "CURRENT"), (30, "DPD_01_30"), (60, "DPD_31_60"), (90, "DPD_61_90")]
LAST_BUCKET = "DPD_90_PLUS"
NPL_DAYS = 90

# State codes that hash-bucket assignment draws from, in this order.
STATE_CODES = ("RO", "AC", "AM", "RR", "PA", "AP", "TO", "MT", "MS", "GO",
               "DF", "SP", "RJ", "MG", "PR", "SC", "RS", "BA", "PE", "CE")

QUARANTINE_KEY_SEPARATOR = "||"
NULL_KEY_TEXT = "NULL"

# ---------------------------------------------------------------------------
# Declared schemas
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 4)

SOURCE_META_FIELDS = [
    T.StructField("source_file_path", T.StringType()),
    T.StructField("source_file_name", T.StringType()),
    T.StructField("source_file_modification_time", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
]

PRODUCT_SOURCE = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("allowed_customer_type", T.StringType()),
    T.StructField("base_annual_interest_rate", RATE),
    T.StructField("max_term_months", T.IntegerType()),
    T.StructField("source_batch_id", T.StringType()),
])

CONTRACT_SOURCE = T.StructType([
    T.StructField("contract_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("contract_date", T.DateType()),
    T.StructField("principal_amount", MONEY),
    T.StructField("annual_interest_rate", RATE),
    T.StructField("term_months", T.IntegerType()),
    T.StructField("contract_status", T.StringType()),
    T.StructField("source_updated_at", T.TimestampType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_batch_id", T.StringType()),
])

CUSTOMER_SOURCE = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("risk_rating", T.StringType()),
    T.StructField("monthly_income", MONEY),
    T.StructField("created_at", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_batch_id", T.StringType()),
])

INSTALLMENT_SOURCE = T.StructType([
    T.StructField("installment_id", T.StringType()),
    T.StructField("contract_id", T.LongType()),
    T.StructField("installment_number", T.IntegerType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("scheduled_amount", MONEY),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_batch_id", T.StringType()),
])

PAYMENT_SOURCE = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("installment_id", T.StringType()),
    T.StructField("contract_id", T.LongType()),
    T.StructField("installment_number", T.IntegerType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("amount_paid", MONEY),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_batch_id", T.StringType()),
])

QUALITY_RESULTS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_timestamp", T.TimestampType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("dataset", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("actual_value", T.StringType(), True),
    T.StructField("expected_value", T.StringType(), True),
    T.StructField("severity", T.StringType(), False),
    T.StructField("details", T.StringType(), True),
])

CONTRACT_VALID_COLUMNS = [
    "contract_id", "customer_id", "product_id", "contract_date", "principal_amount",
    "annual_interest_rate", "term_months", "contract_status", "source_updated_at",
    "source_system", "source_batch_id", "customer_snapshot_date", "source_file_path",
]
CONTRACT_QUARANTINE_COLUMNS = [
    "contract_id", "customer_id", "product_id", "contract_date", "principal_amount",
    "annual_interest_rate", "term_months", "contract_status", "source_updated_at",
    "source_system", "source_batch_id", "source_file_path", "duplicate_rank",
    "error_codes", "error_reasons",
]
PAYMENT_VALID_COLUMNS = [
    "payment_id", "installment_id", "contract_id", "installment_number", "payment_date",
    "amount_paid", "event_type", "event_timestamp", "source_system", "source_batch_id",
    "event_date", "source_file_path",
]
PAYMENT_QUARANTINE_COLUMNS = [
    "payment_id", "installment_id", "contract_id", "installment_number", "payment_date",
    "amount_paid", "event_type", "event_timestamp", "source_batch_id", "event_date",
    "source_file_path", "duplicate_rank", "error_codes", "error_reasons",
]

# Columns each change hash covers (a change elsewhere does not update a row).
CONTRACT_VALID_HASH = ["contract_id", "customer_id", "product_id", "contract_date",
                       "principal_amount", "annual_interest_rate", "term_months",
                       "contract_status", "source_updated_at"]
CONTRACT_QUARANTINE_HASH = ["contract_id", "customer_id", "product_id", "principal_amount",
                            "duplicate_rank", "error_codes"]
CONTRACT_TIE_HASH = ["customer_id", "product_id", "principal_amount", "term_months"]
PAYMENT_VALID_HASH = ["payment_id", "installment_id", "contract_id", "payment_date",
                      "amount_paid", "event_timestamp"]
PAYMENT_QUARANTINE_HASH = ["payment_id", "installment_id", "amount_paid", "duplicate_rank",
                           "error_codes"]
PAYMENT_TIE_HASH = ["installment_id", "contract_id", "installment_number", "payment_date",
                    "amount_paid", "event_type"]
INSTALLMENT_HASH = ["installment_id", "scheduled_amount", "total_paid", "outstanding_amount",
                    "days_past_due", "installment_status", "snapshot_date"]
