"""Evaluation tables from (label, prediction) pairs.

Everything derives from one tiny confusion table (one row per label x
prediction pair), so the scored data is scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts for every (label, prediction) pair over the class spine (absent pairs -> 0)."""
    pairs = pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    classes = pairs.select(F.col("label").alias("c")).union(pairs.select(F.col("prediction").alias("c"))).distinct()
    # class x class spine from the (k-element) class set
    cs = classes.agg(F.collect_set("c").alias("cs"))
    spine = cs.select(F.explode("cs").alias("label"), "cs").select("label", F.explode("cs").alias("prediction"))
    return spine.join(pairs, ["label", "prediction"], "left").fillna(0, subset=["n"])


def per_class(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1, support per class (0 where undefined)."""
    cm = confusion(pred, label, prediction)
    tp = cm.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    pp = cm.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    t = tp.join(sup, "cls").join(pp, "cls")
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return t.withColumn("f1", f1).select("cls", "precision", "recall", "f1", "support")


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, balanced accuracy (mean recall over classes with support), macro F1, weighted F1."""
    pc = per_class(pred, label, prediction)
    return pc.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows plus 'macro avg' and 'weighted avg' rows."""
    pc = per_class(pred, label, prediction).withColumn("cls", F.col("cls").cast("string"))
    macro = pc.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                   F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wavg = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = pc.agg(F.lit("weighted avg").alias("cls"), wavg("precision").alias("precision"),
                      wavg("recall").alias("recall"), wavg("f1").alias("f1"), F.sum("support").alias("support"))
    return pc.unionByName(macro).unionByName(weighted)
