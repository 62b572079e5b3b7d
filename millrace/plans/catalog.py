"""Catalog checks, sources, sinks and bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.plans.registry import query
from millrace.session import load
from millrace.sources import catalog as K, readers as R, sinks
from millrace.sources.staging import fresh_path, stage
from millrace.sources.versions import TableSet

TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
]
_COUNTS_SQL = " union all ".join(f"select '{t}' as table_name, count(*) as rows from {t}" for t in TABLES)

KEYS = {
    "benchmark": ["item_id"], "conversations": ["conv_id", "turn"], "customer": ["c_custkey"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "events": ["event_id"], "labels": ["doc_id"], "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"], "orders": ["o_orderkey"], "pages": ["page_id"], "part": ["p_partkey"],
    "region": ["r_regionkey"], "supplier": ["s_suppkey"],
}
# What each table should hold: fixed rows, rows per supplier (the star tables grow together), or a number for every id
# up to the last one. Invoices are expected, but nobody delivers them.
FIXED = {"region": 5, "nation": 25, "invoice": 412}
PER_SUPPLIER = {"supplier": 1, "customer": 15, "part": 20, "orders": 150, "lineitem": 600, "events": 100}
GAPLESS = {"documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id"}


def _tables(spark, d, names=TABLES):
    return {t: load(spark, d, t) for t in names}


@query("cat_list_tables", _COUNTS_SQL)
def cat_list_tables(spark, d):
    tables = _tables(spark, d)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    found = [t for t in K.table_names(spark, TABLES) if t in tables]
    return K.row_counts({t: spark.table(t) for t in found})


_KIND = ("case typeof(any_value({c})) when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'VARCHAR' then 'string' "
         "when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>' end")
_COLUMNS = {
    "benchmark": "item_id text", "conversations": "conv_id turn role text", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "documents": "doc_id text lang source n_chars", "embeddings": "vec_id embedding label",
    "events": "event_id ts user_id event_type value props", "labels": "doc_id quality toxic",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "nation": "n_nationkey n_name n_regionkey",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "pages": "page_id url html",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "region": "r_regionkey r_name",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
}


def _info_sql(table: str, place: int, column: str) -> str:
    keys = ", ".join(KEYS[table])
    shown = "len(embedding)::varchar || ' values'" if column == "embedding" else f"left({column}::varchar, 40)"
    return (f"select '{table}' as table_name, {place}::bigint as position, '{column}' as column_name, {_KIND.format(c=column)} as data_type, "
            f"count({column}) as filled, (select string_agg(coalesce({shown}, 'NULL'), ' | ' order by {keys}) "
            f"from (select * from {table} order by {keys} limit 3)) as sample from {table}")


@query("cat_table_info", " union all ".join(_info_sql(t, i, c) for t, cols in _COLUMNS.items() for i, c in enumerate(cols.split(), 1)))
def cat_table_info(spark, d):
    parts = [K.described(t, load(spark, d, t), KEYS[t], 3) for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


@query("chk_table_counts", "with e(table_name, expected) as (" + " union all ".join([
    *(f"select '{t}', {n}::bigint" for t, n in FIXED.items()),
    *(f"select '{t}', {n} * count(*)::bigint from supplier" for t, n in PER_SUPPLIER.items()),
    *(f"select '{t}', max({k}) + 1 from {t}" for t, k in GAPLESS.items()),
    "select 'labels', count(distinct doc_id) from labels",
    "select 'conversations', sum(last)::bigint from (select max(turn) + 1 as last from conversations group by conv_id)",
]) + f"), c as ({_COUNTS_SQL}) " + """
select table_name, expected, rows as actual,
       case when rows is null then 'MISSING' when rows = expected then 'ok' else 'MISMATCH' end as status
from e left join c using (table_name)""")
def chk_table_counts(spark, d):
    tables = _tables(spark, d)
    suppliers = tables["supplier"].agg(F.count("*").alias("n"))
    wanted = [
        spark.createDataFrame(list(FIXED.items()), "table_name string, expected bigint"),
        suppliers.select(F.explode(F.create_map(*[F.lit(x) for t, n in PER_SUPPLIER.items() for x in (t, n)])).alias("table_name", "each"), "n")
        .select("table_name", (F.col("each") * F.col("n")).alias("expected")),
        *(tables[t].agg((F.max(k) + 1).alias("expected")).select(F.lit(t).alias("table_name"), "expected") for t, k in GAPLESS.items()),
        tables["labels"].agg(F.countDistinct("doc_id").alias("expected")).select(F.lit("labels").alias("table_name"), "expected"),
        tables["conversations"].groupBy("conv_id").agg((F.max("turn") + 1).alias("last")).agg(F.sum("last").alias("expected"))
        .select(F.lit("conversations").alias("table_name"), "expected"),
    ]
    return K.check_counts(K.row_counts(tables), reduce(DataFrame.unionByName, wanted))


@query("job_ensure_tables", " union all ".join(
    f"select '{t}' as table_name, count(*) as expected, count(*) as actual, 'ok' as status, "
    f"{t in ('orders', 'lineitem')} as rebuilt, 2::bigint as version from {t}" for t in TABLES))
def job_ensure_tables(spark, d):
    source = _tables(spark, d)
    wanted = stage(K.row_counts(source).withColumnRenamed("rows", "expected"), "expected")
    folder = fresh_path(spark, "tables")
    # A damaged start, orders empty and no line items, forces one rebuild of these two; the rest stays where it is. The second
    # call, as any later reader, finds the new version and must leave it alone.
    sound = {t: f"{d}/{t}.parquet" for t in TABLES if t not in ("orders", "lineitem")}
    TableSet(spark, folder).publish({**sound, "orders": source["orders"].filter("false")})
    rebuilt = TableSet(spark, folder).ensure(wanted, lambda names: {n: source[n] for n in names})
    later = TableSet(spark, folder)
    again = later.ensure(wanted, lambda names: {n: source[n] for n in names})
    return later.check(wanted).select(
        "*", F.col("table_name").isin(rebuilt or [""]).alias("rebuilt"), F.lit(later.current()[0] + len(again)).cast("long").alias("version"))


@query("src_text_decode", "select doc_id, md5(text) as digest, length(text) as chars from documents")
def src_text_decode(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text", "lang")
    latin = F.encode("text", "ISO-8859-1")
    fits = F.decode(latin, "ISO-8859-1") == F.col("text")
    # Each text as the bytes some tool might have left: Latin-1 where it fits, with a mark, or plain.
    content = (
        F.when(fits & F.col("lang").isin("fr", "de"), latin)
        .when(F.col("lang") == "en", F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    text = R.decoded_text(F.col("content"))
    return docs.select("doc_id", content.alias("content")).select(
        "doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("chars")
    )


@query("src_json_fallback", "select item_id, text from benchmark")
def src_json_fallback(spark, d):
    mirror = fresh_path(spark, "mirror")
    load(spark, d, "benchmark").write.json(mirror)
    return R.first_readable_json(spark, [fresh_path(spark, "official"), mirror], "item_id bigint, text string")


@query("reg_integrity", """
with known as (select doc_id from labels union select doc_id + 10000000 from labels where toxic = 1)
select coalesce(f.doc_id, k.doc_id) as doc_id, case when k.doc_id is null then 'orphan' else 'dangling' end as status
from (select doc_id from documents) f full join known k on f.doc_id = k.doc_id
where f.doc_id is null or k.doc_id is null""")
def reg_integrity(spark, d):
    labels = load(spark, d, "labels")
    gone = labels.filter("toxic = 1").select((F.col("doc_id") + 10000000).alias("doc_id"))
    return sinks.integrity(load(spark, d, "documents"), labels.select("doc_id").unionByName(gone), "doc_id")


@query("src_binary_data_uri", """
select page_id, concat('data:text/html;base64,', to_base64(encode(html))) as uri from pages""")
def src_binary_data_uri(spark, d):
    return load(spark, d, "pages").select("page_id", R.data_uri(F.encode("html", "UTF-8"), "text/html").alias("uri"))


@query("src_doc_pages", """
select doc_id, len(string_split(text, chr(10))) as pages, replace(text, chr(10), '') as text from documents""")
def src_doc_pages(spark, d):
    pages = R.line_pages(load(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return R.joined_pages(pages, "doc_id")


@query("src_html_pages", "select page_id, url, html from pages")
def src_html_pages(spark, d):
    return load(spark, d, "pages").select("page_id", "url", "html")


@query("vec_store_save_load", """
select vec_id as id, label::varchar as topic, len(embedding) as dims,
       round(list_sum(embedding::double[]), 6) as total from embeddings""")
def vec_store_save_load(spark, d):
    store = load(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.create_map(F.lit("topic"), F.col("label").cast("string")).alias("meta"), "embedding"
    )
    loaded = stage(store, "index")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return loaded.select(
        "id", F.col("meta")["topic"].alias("topic"), F.size("embedding").cast("bigint").alias("dims"),
        F.round(total, 6).alias("total"),
    )


@query("agg_split_sizes", """
with r as (
  select doc_id, quality, row_number() over (partition by quality order by md5(concat('42:', doc_id::varchar)), doc_id) as place,
         round(0.25 * count(*) over (partition by quality)) as n_test from labels)
select case when place <= n_test then 'test' else 'train' end as split, count(*) as rows from r group by 1""")
def agg_split_sizes(spark, d):
    from millrace.operators.features import stratified_split
    rows = load(spark, d, "labels").select("doc_id", "quality")
    return stratified_split(rows, "quality", "doc_id", 0.25, 42).groupBy("split").agg(F.count("*").alias("rows"))


@query("chk_tables_identical", """
with a as (select doc_id, text, lang from documents),
b as (select doc_id, case when lang = 'de' then concat(text, '!') else text end as text, lang from documents)
select (select count(*) from a) as rows_left, (select count(*) from b) as rows_right,
       (select count(*) from (select * from a except all select * from b)) as only_left,
       (select count(*) from (select * from b except all select * from a)) as only_right, true as same_schema""")
def chk_tables_identical(spark, d):
    from millrace.operators.stores import compare_tables
    original = load(spark, d, "documents").select("doc_id", "text", "lang")
    mirror = original.withColumn("text", F.expr("case when lang = 'de' then concat(text, '!') else text end"))
    return compare_tables(original, mirror)
