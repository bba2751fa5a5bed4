"""Fixed column lists of the tables on disk. Text stays text until an operator parses it."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the candidate file, in order.
CANDIDATE = ["split", "image", "label", "class_name", "class_id", "conf", "mode", "max_iou_same_class", "cx", "cy", "w", "h"]
#: What identifies a candidate, with coordinates rounded to six places.
CANDIDATE_KEY = ["split", "image", "class_id", "mode", "cx", "cy", "w", "h"]
# What the verbs need of a file; other columns pass through. The last are the columns that consensus adds.
CONSENSUS_NEEDS = ["split", "image", "class_name", "conf", "mode", "cx", "cy", "w", "h"]
QUEUE_NEEDS = ["split", "image", "class_name", "conf", "mode"]
CONSENSUS_ADDS = ["verifier_conf", "agreement_iou", "consensus_score", "consensus_decision"]

_NUMBERS = {"class_id": T.IntegerType(), **{c: T.DoubleType() for c in ("conf", "max_iou_same_class", "cx", "cy", "w", "h")}}
CANDIDATE_SCHEMA = T.StructType([T.StructField(c, _NUMBERS.get(c, T.StringType())) for c in CANDIDATE])
