"""Schemas of the tables that pass between the layers."""

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_S, _D, _B, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()
_LIST = T.ArrayType(_S)

CONTROLS = _fields(
    ("policy_id", _S), ("requirement_id", _S), ("control_id", _S), ("title", _S), ("description", _S),
    ("metric_key", _S), ("operator", _S), ("threshold", _D), ("severity", _S), ("article", _S),
    ("target_role", _S), ("prediction_role", _S), ("dimension", _S),
    ("quasi_identifiers", _LIST), ("sensitive_attribute", _S), ("sensitive_columns", _LIST),
    ("aggregation", _S), ("average", _S), ("bucket_method", _S), ("buckets", T.IntegerType()),
    ("props", T.MapType(_S, _S)), ("warnings", _LIST), ("shape", _S),
)

METRICS = _fields(("metric_key", _S), ("dimension", _S), ("value", _D), ("n_rows", _L))

RESULTS = _fields(
    ("policy_id", _S), ("requirement_id", _S), ("control_id", _S), ("description", _S), ("metric_key", _S),
    ("dimension", _S), ("actual_value", _D), ("operator", _S), ("threshold", _D), ("passed", _B),
    ("severity", _S), ("article", _S), ("message", _S), ("groups", T.MapType(_S, _D)), ("phase", _S),
    ("evaluated", _B),
)

#: One row per decision of the credit table, after cleaning.
CREDIT = _fields(
    ("checking_status", _S), ("duration", T.IntegerType()), ("credit_history", _S), ("purpose", _S),
    ("credit_amount", _D), ("savings_status", _S), ("employment", _S), ("installment_commitment", T.IntegerType()),
    ("personal_status_sex", _S), ("other_parties", _S), ("residence_since", T.IntegerType()),
    ("property_magnitude", _S), ("age", T.IntegerType()), ("other_payment_plans", _S), ("housing", _S),
    ("existing_credits", T.IntegerType()), ("job", _S), ("num_dependents", T.IntegerType()),
    ("own_telephone", _S), ("foreign_worker", _S), ("class", T.IntegerType()),
)

FACES = _fields(("image_path", _S), ("race", _S), ("gender", _S), ("age", T.IntegerType()))

COHORT = _fields(("PatientID", _S), ("SpineVol", _L), ("Confidence", _D), ("Dice", _D), ("Jaccard", _D))

SCAN_METADATA = _fields(
    ("PatientID", _S), ("Sex", _S), ("Age", T.IntegerType()), ("Manufacturer", _S), ("ModelName", _S), ("KVP", _D),
    ("SliceThickness", _D), ("Exposure", _D), ("StudyDate", _S), ("PixelSpacing0", _D), ("PixelSpacing1", _D),
    ("PatientWeight", _D), ("PatientSize", _D),
)
