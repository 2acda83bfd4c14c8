"""Source, table and action queries."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.analysis import analyze_array, text_tokens
from quarry.functions.predicates import match, nested
from quarry.functions.project import record
from quarry.operators.actions import action_outcomes, actions_from_json, apply_actions
from quarry.operators.ingest import ChangeLogTable, append, create_table, upsert, with_generated_id
from quarry.plans.common import load, sql_tokens
from quarry.plans.ingest_queries import PART_TYPES, part_lines
from quarry.session import scratch_dir
from quarry.sources import commit_export
from quarry.sources.commits import EntityTable, read_commits
from quarry.sources.delimited import MALFORMED, load_typed_delimited, read_delimited
from quarry.sources.tables import lookup_many, scan_tables, write_by_key


def _new_path(spark, name):
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


# --- S1, U3: commit records ---------------------------------------------------

def _export(spark, d):
    """Orders as exported commits: an order's parent is the order before it of the same clerk's half."""
    o = load(spark, d, "orders")
    day = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    person = F.struct(F.concat(F.lit("c"), F.col("o_custkey")).alias("name"), F.lit("c@x").alias("email"))
    files = F.map_from_arrays(F.array(F.concat(F.lit("src/"), F.col("o_orderstatus"))), F.array(F.struct((F.col("o_orderkey") % 7).alias("lines"))))
    raw = o.select(F.col("o_orderkey").cast("string").alias("hexsha"), day.alias("committed_date"), person.alias("committer"),
                   (day - 3600).alias("authored_date"), person.alias("author"), F.concat("o_orderpriority", F.lit("\nbody")).alias("message"),
                   F.when(F.col("o_orderkey") > 1, F.array(F.struct(F.expr("o_orderkey div 2").cast("string").alias("hexsha")))).otherwise(F.array()).alias("parents"),
                   F.struct(files.alias("files"), F.struct((F.col("o_orderkey") % 7).alias("lines"), F.lit(1).alias("files")).alias("total")).alias("stats"))
    path = _new_path(spark, "commits")
    raw.write.json(path)
    return path


def _flat(commits):
    return commits.select("_id", "repository", F.date_format("committed_date", "yyyy-MM-dd HH:mm:ss").alias("committed"),
                          F.date_format("authored_date", "yyyy-MM-dd HH:mm:ss").alias("authored"), F.col("committer.name").alias("committer"),
                          F.col("description"), F.array_join("parent_shas", ",").alias("parents"), F.array_join("files", ",").alias("files"),
                          F.col("stats.lines").alias("lines"))


def commit_records(spark, d):
    return _flat(read_commits(spark, _export(spark, d), "orders"))


def commit_export_source(spark, d):
    """The same rows through the registered data source."""
    commit_export.register(spark)
    return _flat(spark.read.format(commit_export.FORMAT).option("repository", "orders").load(_export(spark, d)))


def commit_export_stream(spark, d):
    """The same rows once more, read as a stream into a table."""
    commit_export.register(spark)
    path = _new_path(spark, "commit-stream")
    stream = spark.readStream.format(commit_export.FORMAT).option("repository", "orders").load(_export(spark, d))
    stream.writeStream.format("parquet").option("path", f"{path}/t").option("checkpointLocation", f"{path}/c").trigger(once=True).start().awaitTermination()
    return _flat(spark.read.parquet(f"{path}/t"))


# --- S3, S5: delimited files --------------------------------------------------

def csv_untyped_load(spark, d):
    """A plain load of typed lines: every value a string, type lines among the rows, nothing malformed."""
    lines = load_typed_delimited(spark, part_lines(spark, d), type_row=False)
    typed = F.lit(True)
    for c, name in PART_TYPES.items():
        typed = typed & (F.col(c) == name)
    return lines.where(~typed).select(*PART_TYPES, F.col(MALFORMED).isNull().alias("whole"))


def csv_quoted_texts(spark, d):
    """Texts with quotes, separators and line breaks, written and read back by many tasks."""
    path = _new_path(spark, "quoted")
    docs = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit('he said "a;b"\n'), F.coalesce("text", F.lit(""))).alias("text"))
    (docs.write.option("sep", ";").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = read_delimited(spark, path)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.length("text").cast("bigint").alias("n"), F.sha2("text", 256).alias("sha"))


# --- S7-S11: tables -------------------------------------------------------------

def tables_below_path(spark, d):
    """Every table below the base path whose name ends in ``er``."""
    return scan_tables(spark, "*er", base=d).select(F.coalesce("c_name", "s_name").alias("name"), F.coalesce("c_acctbal", "s_acctbal").alias("acctbal"), "_index")


def tables_of_catalog(spark, d):
    """Every catalog table or view that a name pattern finds."""
    for name in ("nation", "region", "customer"):
        load(spark, d, name).createOrReplaceTempView(f"quarry_scan_{name}")
    return scan_tables(spark, "quarry_scan_*ion").select(F.coalesce("n_name", "r_name").alias("name"), "_index")


def keys_lookup(spark, d):
    """Many keys at once from a table written for lookups, by hashes that no range holds together."""
    path = _new_path(spark, "by-key")
    hashed = load(spark, d, "orders").select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("_id"), "o_orderkey", "o_totalprice")
    write_by_key(hashed, path, "_id", files=4)
    wanted = [r["_id"] for r in hashed.where("o_orderkey in (1, 7, 1000, 5000, 14999)").select("_id").collect()]
    return lookup_many(spark.read.parquet(path), "_id", [*wanted, "none"]).select("_id", "o_totalprice")


def entity_rows(spark, d):
    """Rows of an entity class over the tables of a name pattern: declared and computed columns, and where a row is from."""
    path = _new_path(spark, "entities")
    docs = load(spark, d, "documents")
    parts = {"git-1": docs.where("doc_id % 2 = 0"), "git-2": docs.where("doc_id % 2 = 1"), "other": docs}
    for name, some in parts.items():
        some.select("doc_id", F.col("text").alias("description"), "lang").write.parquet(f"{path}/{name}.parquet")
    entity = EntityTable("git*", T.StructType([T.StructField("description", T.StringType()), T.StructField("author", T.StringType())]), id_column="doc_id")
    rows = entity.search(spark, base=path, where=match("description", "heti"))
    return rows.select("_id", "subject", F.col("author").isNull().alias("no_author"), "_index")


# --- K1-K6: tables, keyed writes, actions --------------------------------------

def create_table_modes(spark, d):
    """An empty table with a declared schema, created twice, refused the third time, then filled."""
    nation, path = load(spark, d, "nation"), f"{_new_path(spark, 'create')}/nation"
    create_table(spark, path, nation.schema)
    empty = spark.read.parquet(path).count()
    create_table(spark, path, nation.schema)
    try:
        create_table(spark, path, nation.schema, if_exists="error")
        refused = False
    except AnalysisException:
        refused = True
    append(nation, path)
    return spark.read.parquet(path).select("n_nationkey", "n_name", F.lit(empty).alias("empty"), F.lit(refused).alias("refused"))


def append_generated_keys(spark, d):
    """The same rows loaded twice: appended without a key they double, under content keys they do not."""
    nation, path = load(spark, d, "nation"), f"{_new_path(spark, 'append')}/nation"
    append(with_generated_id(nation), path)
    append(with_generated_id(nation), path)
    back = spark.read.parquet(path)
    keyed = with_generated_id(nation, content_key=True)
    kept = upsert(keyed, keyed, "_id", ["n_nationkey"])
    return back.agg(F.count("*").alias("rows"), F.count_distinct("_id").alias("keys")).crossJoin(kept.agg(F.count("*").alias("kept")))


def upsert_widened_log(spark, d):
    """A change log whose version column grows from int to bigint, whose equal versions come again later, and
    whose first batch was left half written once."""
    ev, path = load(spark, d, "events"), _new_path(spark, "log")
    t = ChangeLogTable(spark, path, "user_id", ["v"])
    small = ev.select("user_id", F.lit(1).alias("v"), F.lit("first").alias("batch_name")).distinct()
    spark.range(3).write.parquet(f"{path}/log/quarry_batch=000000000000/_temporary/0")
    t.append_changes(small, 0)
    t.append_changes(small.where("user_id % 2 = 0").withColumn("v", F.lit(1).cast("bigint")).withColumn("batch_name", F.lit("again")), 1)
    t.compact(1)
    t.append_changes(small.where("user_id % 3 = 0").withColumn("v", F.lit(5_000_000_000).cast("bigint")).withColumn("batch_name", F.lit("wide")), 2)
    return t.current()


ACTION_FIELDS = T.StructType([T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType()),
                              T.StructField("c_mktsegment", T.StringType()), T.StructField("last_order", T.LongType())])


def _actions(spark, d):
    """Orders as action lines on customers: every 11th deletes, every 7th writes the document anew, the others
    update one field, the low priorities by an explicit null; every 13th names a customer that there is none of."""
    o = load(spark, d, "orders")
    key = F.when(F.col("o_orderkey") % 13 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")).cast("string")
    anew = F.to_json(F.struct(key.alias("_id"), F.concat(F.lit("order "), F.col("o_orderkey")).alias("c_name"), F.col("o_orderkey").alias("last_order")))
    text = F.col("o_orderkey").cast("string")

    def update(doc):
        return F.concat(F.lit('{"_id": "'), key, F.lit('", "_op_type": "update", "doc": {'), doc, F.lit("}}"))
    line = (F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit('{"_id": "'), key, F.lit('", "_op_type": "delete"}')))
            .when(F.col("o_orderkey") % 7 == 0, anew)
            .when(F.col("o_orderpriority") == "5-LOW", update(F.concat(F.lit('"c_mktsegment": null, "last_order": '), text)))
            .when(F.col("o_orderpriority") == "1-URGENT", update(F.concat(F.lit('"c_acctbal": '), text, F.lit(".5"))))
            .otherwise(update(F.concat(F.lit('"last_order": '), text))))
    return actions_from_json(o.select(F.col("o_orderkey").alias("seq"), line.alias("value")), ACTION_FIELDS)


def _action_base(spark, d):
    return load(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")


def action_stream(spark, d):
    return apply_actions(_action_base(spark, d), _actions(spark, d), "_id", "seq")


def action_results(spark, d):
    return action_outcomes(_action_base(spark, d), _actions(spark, d), "_id", "seq")


# --- P15, T8: arrays --------------------------------------------------------------

def nested_structs(spark, d):
    """Both conditions on one element of an array of structs."""
    part = load(spark, d, "part").select("p_partkey", F.array(record(word="p_name", kind="p_type"), record(word="p_brand", kind="p_name")).alias("items"))
    return part.where(nested("items", lambda x: match(x["word"], "ring") & match(x["kind"], "economy"))).select("p_partkey")


def array_tokens(spark, d):
    part = load(spark, d, "part")
    both = analyze_array(F.array("p_name", "p_type"), text_tokens, distinct=True)
    return part.select("p_partkey", F.array_join(both, " ").alias("tokens"))


QUERIES = {
    "commit_records": commit_records, "commit_export_source": commit_export_source, "commit_export_stream": commit_export_stream,
    "csv_untyped_load": csv_untyped_load, "csv_quoted_texts": csv_quoted_texts, "tables_below_path": tables_below_path,
    "tables_of_catalog": tables_of_catalog, "keys_lookup": keys_lookup, "entity_rows": entity_rows,
    "create_table_modes": create_table_modes, "append_generated_keys": append_generated_keys, "upsert_widened_log": upsert_widened_log,
    "action_stream": action_stream, "action_results": action_results, "nested_structs": nested_structs, "array_tokens": array_tokens,
}

_TOK = sql_tokens
_COMMITS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS _id, 'orders' AS repository, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS committed,
           strftime(o_orderdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS authored, 'c' || o_custkey AS committer,
           o_orderpriority || chr(10) || 'body' AS description, CASE WHEN o_orderkey > 1 THEN CAST(o_orderkey // 2 AS VARCHAR) ELSE '' END AS parents,
           'src/' || o_orderstatus AS files, o_orderkey % 7 AS lines FROM orders"""

_ACTIONS = """
    a AS (SELECT o_orderkey AS seq, CAST(CASE WHEN o_orderkey % 13 = 0 THEN -o_custkey ELSE o_custkey END AS VARCHAR) AS _id,
                 CASE WHEN o_orderkey % 11 = 0 THEN 'delete' WHEN o_orderkey % 7 = 0 THEN 'index' ELSE 'update' END AS op, o_orderpriority AS pri FROM orders),
    b AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer)"""

ORACLE = {
    "commit_records": _COMMITS, "commit_export_source": _COMMITS, "commit_export_stream": _COMMITS,
    "csv_untyped_load": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               CAST(p_retailprice AS VARCHAR) AS p_retailprice, true AS whole FROM part""",
    "csv_quoted_texts": """
        SELECT doc_id, length(t) AS n, sha256(t) AS sha FROM (SELECT doc_id, 'he said "a;b"' || chr(10) || coalesce(text, '') AS t FROM documents)""",
    "tables_below_path": """
        SELECT c_name AS name, c_acctbal AS acctbal, 'customer' AS _index FROM customer
        UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier""",
    "tables_of_catalog": """
        SELECT n_name AS name, 'quarry_scan_nation' AS _index FROM nation UNION ALL SELECT r_name, 'quarry_scan_region' FROM region""",
    "keys_lookup": """
        SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS _id, o_totalprice FROM orders WHERE o_orderkey IN (1, 7, 1000, 5000, 14999)""",
    "entity_rows": f"""
        SELECT CAST(doc_id AS VARCHAR) AS _id, left(string_split(text, chr(10))[1], 80) AS subject, true AS no_author,
               CASE WHEN doc_id % 2 = 0 THEN 'git-1' ELSE 'git-2' END AS _index FROM documents WHERE list_contains({_TOK('text')}, 'heti')""",
    "create_table_modes": "SELECT n_nationkey, n_name, 0 AS empty, true AS refused FROM nation",
    "append_generated_keys": "SELECT 2 * count(*) AS rows, 2 * count(*) AS keys, count(*) AS kept FROM nation",
    "upsert_widened_log": """
        SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN 5000000000 ELSE 1 END AS v,
               CASE WHEN user_id % 3 = 0 THEN 'wide' WHEN user_id % 2 = 0 THEN 'again' ELSE 'first' END AS batch_name FROM events""",
    "action_stream": f"""
        WITH {_ACTIONS},
        r AS (SELECT _id, max(seq) AS at, arg_max(op, seq) AS op FROM a WHERE op <> 'update' GROUP BY _id),
        u AS (SELECT a._id, max(seq) FILTER (pri = '1-URGENT') AS acct, bool_or(pri = '5-LOW') AS low,
                     max(seq) FILTER (pri <> '1-URGENT') AS last FROM a LEFT JOIN r USING (_id)
              WHERE a.op = 'update' AND (r.at IS NULL OR a.seq > r.at) GROUP BY a._id)
        SELECT coalesce(b._id, r._id) AS _id, CASE WHEN r.at IS NULL THEN b.c_name ELSE 'order ' || r.at END AS c_name,
               CASE WHEN u.acct IS NOT NULL THEN u.acct + 0.5 WHEN r.at IS NULL THEN b.c_acctbal END AS c_acctbal,
               CASE WHEN NOT coalesce(u.low, false) AND r.at IS NULL THEN b.c_mktsegment END AS c_mktsegment,
               CASE WHEN r.at IS NULL THEN b.c_nationkey END AS c_nationkey,
               coalesce(u.last, r.at) AS last_order
        FROM b FULL JOIN r ON b._id = r._id LEFT JOIN u ON u._id = coalesce(b._id, r._id)
        WHERE CASE WHEN r.at IS NULL THEN b._id IS NOT NULL ELSE r.op = 'index' END""",
    "action_results": f"""
        WITH {_ACTIONS},
        w AS (SELECT *, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (
                  PARTITION BY _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM a),
        e AS (SELECT w.*, CASE WHEN was IS NULL THEN b._id IS NOT NULL ELSE was = 'index' END AS there FROM w LEFT JOIN b USING (_id))
        SELECT _id, seq, op AS _op_type,
               CASE WHEN op <> 'index' AND NOT there THEN 'failed' WHEN op = 'delete' THEN 'deleted' WHEN there THEN 'updated' ELSE 'created' END AS status,
               CASE WHEN there OR op = 'index' THEN NULL WHEN op = 'update' THEN 'document_missing' ELSE 'not_found' END AS _error FROM e""",
    "nested_structs": f"""
        SELECT p_partkey FROM part
        WHERE (list_contains({_TOK('p_name')}, 'ring') AND list_contains({_TOK('p_type')}, 'economy'))
           OR (list_contains({_TOK('p_brand')}, 'ring') AND list_contains({_TOK('p_name')}, 'economy'))""",
    "array_tokens": f"""
        SELECT p_partkey, list_aggregate(list_filter(l, lambda x, i: list_position(l, x) = i), 'string_agg', ' ') AS tokens
        FROM (SELECT p_partkey, list_concat({_TOK('p_name')}, {_TOK('p_type')}) AS l FROM part)""",
}
