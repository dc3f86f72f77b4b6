"""Class probabilities of the status style: softmax, gates, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes in order, and the tags of labels (label, platform, review tag, needs review, reason).
STYLE_CLASSES = ["check_offset", "check_aligned", "check_absent"]
BUSINESS_TAGS = {"check_offset": "android", "check_aligned": "ios", "check_absent": "suspected_fake", "unknown": "review"}
RULE_VERSION = "status-style-v2"
TAGS = [
    ("check_offset", "android", None, False, "status_check_offset"),
    ("check_aligned", "ios", None, False, "status_check_aligned"),
    ("check_absent", None, "suspected_fake", True, "status_check_absent"),
]
OTHER_TAGS = (None, "review", True, "status_style_low_confidence")


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def gate_style(probs: Column, threshold: float = 0.70, absent_threshold: float = 0.85) -> Column:
    """Struct (label, confidence, candidate): the first largest class if it passes its gate, else unknown; null for
    probabilities that aren't three finite numbers in [0, 1]."""
    if not 0 <= threshold <= absent_threshold <= 1:
        raise ValueError("thresholds must be in [0, 1], the one for absent checks not the lower")
    top = F.array_max(probs)
    candidate = F.element_at(F.array(*map(F.lit, STYLE_CLASSES)), F.array_position(probs, top).cast("int"))
    need = F.when(candidate == "check_absent", absent_threshold).otherwise(threshold)
    good = (F.size(probs) == 3) & F.forall(probs, lambda p: p.isNotNull() & ~F.isnan(p) & p.between(0, 1))
    return F.when(good, F.struct(F.when(top >= need, candidate).otherwise("unknown").alias("label"), top.alias("confidence"), candidate.alias("candidate")))


def business_tag(label: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in BUSINESS_TAGS.items() for x in kv])[label], F.lit("review"))


def style_tags(df: DataFrame) -> DataFrame:
    """`df` with the review tags of its label. Tags are review signals; authenticity is never assessed."""
    dim = df.sparkSession.createDataFrame(TAGS, "label string, platform string, review_tag string, requires_manual_review boolean, reason string")
    out = df.join(F.broadcast(dim.withColumn("_known", F.lit(True))), "label", "left")
    other = dict(zip(["platform", "review_tag", "requires_manual_review", "reason"], OTHER_TAGS))
    out = out.withColumns({c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(v)) for c, v in other.items()})
    return out.withColumns({"authenticity": F.lit("not_assessed"), "rule_version": F.lit(RULE_VERSION)}).drop("_known")


def style_record(boxes: DataFrame, gated: DataFrame, model: str, config: float, schema_version: int = 2) -> DataFrame:
    """Per strongest status box (image_id, x1..y2) the record of its style: classified, in review, or unavailable where it has no
    class probabilities; with the box (in full; it is rounded on export) and the model and config that made it."""
    rows = boxes.join(gated, "image_id", "left")
    known = F.col("label").isNotNull()
    label = F.coalesce("label", F.lit("unknown"))
    return rows.withColumns({
        "schema_version": F.lit(schema_version), "state": F.when(~known, "unavailable").when(label == "unknown", "review").otherwise("classified"),
        "business_tag": business_tag(label), "candidate_label": F.coalesce("candidate", F.lit("unknown")), "confidence": F.round(F.coalesce("confidence", F.lit(0.0)), 9),
        "model": F.lit(model), "config": F.lit(config), "label": label,
    }).drop("candidate")
