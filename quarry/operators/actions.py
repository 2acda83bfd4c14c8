"""A stream of actions on keyed documents: index, partial update, delete (K6).

The final documents come from one aggregation that combines map-side: per key the last
action that sets or removes the whole document, and per field the last value that
an update gave. A field's update counts if it is later than that action, so any
interleaving of a key's actions composes in order without being sorted or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.graph import last_before

# Names of the actions; no name means ``index``.
INDEX, UPDATE, DELETE = "index", "update", "delete"


def actions_from_json(lines: DataFrame, fields: T.StructType, key: str = "_id", seq: str = "seq", column: str = "value") -> DataFrame:
    """Action lines as (key, seq, ``_op_type``, ``doc``, ``given``).

    A line is a JSON object with the key, an optional ``_op_type`` and, for an update, the
    partial document under ``doc``; an index action has its fields beside the key. ``given``
    names the fields of an update's ``doc``, so that an explicit null is told apart from a
    field that is left out.
    """
    shape = T.StructType([T.StructField(key, T.StringType()), T.StructField("_op_type", T.StringType()), T.StructField("doc", fields),
                          *[f for f in fields.fields if f.name not in (key, "doc", "_op_type")]])
    line = F.from_json(column, shape)
    op = F.coalesce(line["_op_type"], F.lit(INDEX))
    own = F.struct(*[line[f.name].alias(f.name) for f in fields.fields])
    return lines.select(line[key].alias(key), F.col(seq), op.alias("_op_type"),
                        F.when(op == UPDATE, line["doc"]).otherwise(own).alias("doc"),
                        F.when(op == UPDATE, F.json_object_keys(F.get_json_object(column, "$.doc"))).alias("given"))


def _given(name: str) -> Column:
    return F.when(F.col("given").isNull(), F.col(f"doc.{name}").isNotNull()).otherwise(F.array_contains("given", name))


def _prepared(actions: DataFrame, key: str, seq: str) -> DataFrame:
    """Only the columns that matter, the default action filled in, keyless index actions keyed by content."""
    has_given = "given" in actions.columns
    op = F.coalesce(F.col("_op_type"), F.lit(INDEX))
    made = F.sha2(F.concat_ws("\x1f", F.col(seq).cast("string"), F.to_json("doc")), 256)
    text_key = isinstance(actions.schema[key].dataType, T.StringType)
    own = F.when(F.col(key).isNull() & (op == INDEX), made).otherwise(F.col(key)) if text_key else F.col(key)
    return actions.select(own.alias(key), F.col(seq), op.alias("_op_type"), "doc",
                          (F.col("given") if has_given else F.lit(None).cast("array<string>")).alias("given"))


def apply_actions(base: DataFrame, actions: DataFrame, key: str, seq: str) -> DataFrame:
    """``base`` after all ``actions`` of each key in the order of ``seq``.

    ``actions`` has the key, ``seq``, ``_op_type`` (null: index), ``doc`` (a struct) and
    optionally ``given``, the names of the fields that an update gives (null or no such
    column: those that are not null).

    - index replaces the document: columns that ``doc`` lacks become null;
    - update sets the given fields, to null too, of a document that is there at that time;
    - delete removes it; an update after it has no effect until the next index.

    Fields unknown to ``base`` become columns. Of actions of a key with equal ``seq`` a delete comes
    last, then an index, and equal ones are ordered by content. Unknown actions, updates of missing
    documents and, where the key is no string, actions without a key change nothing;
    ``action_outcomes`` names them. An index without a string key gets a hash of its content.
    """
    acts = _prepared(actions, key, seq).where(F.col(key).isNotNull() & F.col("_op_type").isin(INDEX, UPDATE, DELETE))
    fields = [f.name for f in acts.schema["doc"].dataType.fields if f.name != key]
    rank = F.when(F.col("_op_type") == DELETE, 2).when(F.col("_op_type") == INDEX, 1).otherwise(0)
    at = F.struct(F.col(seq).alias("s"), rank.alias("r"), F.xxhash64(F.to_json("doc")).alias("h"))
    whole = F.when(F.col("_op_type") != UPDATE, at)
    aggs = [F.max(whole).alias("_reset"), F.max_by("_op_type", whole).alias("_last"), F.max_by("doc", whole).alias("_doc")]
    for i, f in enumerate(fields):
        gives = F.when((F.col("_op_type") == UPDATE) & _given(f), at)
        aggs += [F.max(gives).alias(f"_at{i}"), F.max_by(F.col(f"doc.{f}"), gives).alias(f"_v{i}")]
    folded = acts.groupBy(key).agg(*aggs)
    both = base.withColumn("_base", F.lit(True)).join(folded, key, "full")
    alive = F.when(F.col("_reset").isNull(), F.col("_base")).otherwise(F.col("_last") == INDEX)
    out = [F.col(key)]
    for c in [*[c for c in base.columns if c != key], *[f for f in fields if f not in base.columns]]:
        old = F.col(c) if c in base.columns else F.lit(None)
        if c not in fields:
            out.append(F.when(F.col("_reset").isNull(), old).alias(c))
            continue
        i = fields.index(c)
        late = F.col(f"_at{i}").isNotNull() & (F.col("_reset").isNull() | (F.col(f"_at{i}") > F.col("_reset")))
        out.append(F.when(late, F.col(f"_v{i}")).when(F.col("_reset").isNotNull(), F.col(f"_doc.{c}")).otherwise(old).alias(c))
    return both.where(F.coalesce(alive, F.lit(False))).select(*out)


def action_outcomes(base: DataFrame, actions: DataFrame, key: str, seq: str) -> DataFrame:
    """Per action (key, seq, ``_op_type``) its ``status`` and, where it failed, its ``_error``.

    Whether a document is there at the time depends on the key's last index or delete
    before, else on ``base``. A key with a large part of all actions is cut into blocks
    (``last_before``). ``seq`` is a number, distinct within a key.
    """
    acts = _prepared(actions, key, seq).select(key, seq, "_op_type")
    sets = F.when(F.col("_op_type").isin(INDEX, DELETE), F.col("_op_type") == INDEX)
    acts = last_before(acts.withColumn("_sets", sets), key, seq, "_sets", "_was").drop("_sets")
    there = base.select(F.col(key).alias("_k")).distinct()
    acts = acts.join(there, F.col(key) == F.col("_k"), "left")
    exists = F.coalesce("_was", F.col("_k").isNotNull())
    op = F.col("_op_type")
    error = (F.when(~op.isin(INDEX, UPDATE, DELETE), F.lit("unknown_action")).when(F.col(key).isNull(), F.lit("key_missing"))
             .when((op == UPDATE) & ~exists, F.lit("document_missing")).when((op == DELETE) & ~exists, F.lit("not_found")))
    done = F.when(op == DELETE, F.lit("deleted")).when(exists, F.lit("updated")).otherwise(F.lit("created"))
    return acts.select(key, seq, "_op_type", F.when(error.isNull(), done).otherwise(F.lit("failed")).alias("status"), error.alias("_error"))
