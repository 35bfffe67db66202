"""Folders of awkward tables: empty ones, and ones with null rows, repeated rows and extra columns of clashing names."""

from pyspark.sql import functions as F

TABLES = ["companies", "raw_records", "match_pairs", "founder_company_edges", "source_run_stats", "harvest_runs", "source_registry", "documents", "eval_items", "mixture_targets"]
CLASHING = ["key", "node", "pid", "group_id", "cell", "own", "v", "rep", "a", "b", "star", "score", "trust", "seen", "n", "value", "field_name", "change", "template", "slots", "n_tokens", "restored", "confidence", "gamma", "host", "class"]
KEYS = {"companies": "id", "raw_records": "id", "match_pairs": "pair_id", "founder_company_edges": "id", "source_run_stats": "id", "harvest_runs": "id", "source_registry": "source_name", "documents": "doc_id", "eval_items": "item_id", "mixture_targets": "source"}


def empty(spark, source, target):
    for t in TABLES:
        spark.read.parquet(f"{source}/{t}.parquet").limit(0).write.parquet(f"{target}/{t}.parquet")
    return target


def awkward(spark, source, target):
    for t in TABLES:
        df = spark.read.parquet(f"{source}/{t}.parquet")
        key = df.schema[KEYS[t]]
        nulls = df.limit(1).select(*[(F.lit("null-row" if key.dataType.typeName() == "string" else 10**9).cast(f.dataType) if f.name == key.name else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields])
        if t in ("companies", "documents", "match_pairs", "eval_items"):
            df = df.unionByName(df.limit(40))
        df = df.unionByName(nulls)
        extra = [c for c in CLASHING if c not in df.columns]
        df.select("*", *[F.lit("x").alias(c) for c in extra]).write.parquet(f"{target}/{t}.parquet")
    return target
