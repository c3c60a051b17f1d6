"""Keyed maintenance and incremental selection (SNK-*, INC-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import stored
from issuerlake.operators import tables as X
from issuerlake.plans.catalog.base import query
from issuerlake.session import scratch_folder
from issuerlake.streaming.ingest import ingest_available, upserting

_KEY = ["o_orderkey"]
_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "o_totalprice", "o_orderpriority"]
_NOW = "2024-02-01 00:00:00"


def _target(t):
    return t.orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.lit(None).cast("timestamp").alias("touched")
    )


def _updates(t):
    return t.lineitem.where("l_returnflag <> 'N'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"),
        F.nullif("l_returnflag", F.lit("R")).alias("o_orderpriority"), "l_linenumber", "l_partkey", "l_suppkey",
    )


_UPDATES_SQL = f"""u as (select l_orderkey as k, l_extendedprice as price, nullif(l_returnflag, 'R') as priority from (select *, row_number() over (partition by l_orderkey
  order by l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, nullif(l_returnflag, 'R') desc nulls last) as rn from lineitem where l_returnflag <> 'N') where rn = 1),
t as (select * from orders where o_orderstatus <> 'F')"""


def _shown(df):
    return df.withColumn("touched", F.date_format("touched", "yyyy-MM-dd HH:mm:ss"))


@query("upserted", f"""
with {_UPDATES_SQL} select coalesce(t.o_orderkey, u.k) as o_orderkey, o_custkey, case when u.k is not null then price else o_totalprice end as o_totalprice,
  case when u.k is not null then priority else o_orderpriority end as o_orderpriority, case when u.k is not null then '{_NOW}' end as touched from t full join u on u.k = t.o_orderkey
""")
def _(t):
    return _shown(X.upsert(_target(t), _updates(t), _KEY, order=_ORDER, touch="touched", now=F.lit(_NOW).cast("timestamp")))


@query("upserted_columns", f"""
with {_UPDATES_SQL} select coalesce(t.o_orderkey, u.k) as o_orderkey, o_custkey, case when u.k is not null then price else o_totalprice end as o_totalprice,
  o_orderpriority from t full join u on u.k = t.o_orderkey
""")
def _(t):
    return X.upsert(_target(t), _updates(t), _KEY, columns=["o_totalprice"], order=_ORDER).drop("touched")


@query("inserted_new", f"""
with {_UPDATES_SQL} select o_orderkey, o_totalprice, o_orderpriority from t union all select k, price, priority from u where k not in (select o_orderkey from t)
""")
def _(t):
    return X.insert_new(_target(t), _updates(t), _KEY, order=_ORDER).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("inserted_by_force", f"""
with {_UPDATES_SQL} select coalesce(t.o_orderkey, u.k) as o_orderkey, case when u.k is not null then price else o_totalprice end as o_totalprice from t full join u on u.k = t.o_orderkey
""")
def _(t):
    return X.insert_new(_target(t), _updates(t), _KEY, force=True, order=_ORDER).select("o_orderkey", "o_totalprice")


@query("updated_titles", """
select d.doc_id, case when l.quality = 1 then concat('Documento ', d.doc_id) else d.lang end as titulo from documents d left join labels l on l.doc_id = d.doc_id
""")
def _(t):
    titles = t.labels.select("doc_id", F.when(F.col("quality") == 1, F.concat(F.lit("Documento "), "doc_id")).otherwise("").alias("titulo"))
    return X.update_column(t.documents.select("doc_id", F.col("lang").alias("titulo")), titles, ["doc_id"], "titulo")


@query("changed_files", """
select d.doc_id as path from documents d left join labels l on l.doc_id = d.doc_id where l.doc_id is null or l.quality = 0
""")
def _(t):
    listing = t.documents.select(F.col("doc_id").alias("path"), F.col("n_chars").alias("modified_at"))
    tracker = t.labels.join(t.documents, "doc_id").select(
        F.col("doc_id").alias("path"), (F.col("n_chars") + 1 - F.col("quality")).alias("modified_at")
    )
    return X.changed_files(listing, tracker).select("path")


@query("outdated_outputs", """
with i as (select user_id, max(ts) as a from events group by 1), o as (select user_id, max(ts) as b from events where event_type = 'purchase' and value > 50 group by 1)
select i.user_id from i left join o on o.user_id = i.user_id where b is null or b <= a
""")
def _(t):
    inputs = t.events.select("user_id", F.col("ts").alias("modified_at"))
    outputs = t.events.where("event_type = 'purchase' and value > 50").select("user_id", F.col("ts").alias("modified_at"))
    return X.outdated_outputs(inputs, outputs, "user_id").select("user_id")


@query("listing_diff", """
select coalesce(d.doc_id, l.path) as path, case when l.path is null then 'new' when d.doc_id is null then 'extra' when l.quality = 1 then 'same' else 'changed' end as state
from (select * from documents where lang <> 'fr') d full join (select l.doc_id as path, quality from labels l join documents using (doc_id)) l on l.path = d.doc_id
""")
def _(t):
    listing = t.documents.select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size"), F.col("n_chars").alias("modified_at"))
    source = listing.join(t.documents.where("lang <> 'fr'").select(F.col("doc_id").alias("path")), "path", "left_semi")
    other = t.labels.join(t.documents, "doc_id").select(
        F.col("doc_id").alias("path"), F.col("n_chars").alias("size"),
        (F.col("n_chars") + F.when(F.col("quality") == 1, 0.5).otherwise(1.0)).alias("modified_at"),
    )
    return X.listing_diff(source, other)


@query("new_keys", """
select distinct user_id, strftime(ts, '%Y-%m-%d') as day from events where event_type = 'click'
except select user_id, strftime(ts, '%Y-%m-%d') from events where event_type = 'view'
""")
def _(t):
    days = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return X.new_keys(days.where("event_type = 'click'"), days.where("event_type = 'view'"), ["user_id", "day"])


@query("streamed_history", """
select user_id, day, event_id, value from (select user_id, strftime(ts, '%Y-%m-%d') as day, event_id, value,
  row_number() over (partition by user_id, cast(ts as date) order by event_id desc) as rn from events) where rn = 1
""")
def _(t):
    """Events as landing files: streamed into a stored table, newest event per user and day."""
    root = scratch_folder(t.spark, "streamed-history")
    table = f"{root}/table"

    def clean(df):
        return df.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "value")

    ingest_available(
        t.spark, t.folder, t.events.schema, upserting(table, ["user_id", "day"], clean=clean, order=["event_id"], buckets=8),
        f"{root}/checkpoint", fmt="parquet", pathGlobFilter="events.parquet",
    )
    return stored.read_table(t.spark, table).select("user_id", "day", "event_id", "value")


_PAD = "lpad(cast({} as varchar), 10, '0')"
_STORED_SQL = f"""t as (select {_PAD.format("o_orderkey")} as code, nullif(substr(o_orderpriority, 1, 1), '1') as line, o_totalprice as price, o_orderstatus as status from orders),
u as (select {_PAD.format("l_orderkey")} as code, nullif(cast(l_linenumber as varchar), '1') as line, max(l_extendedprice) as price from lineitem group by 1, 2)"""


def _first(t):
    """Keys with leading zeros, and a part that may be null."""
    code = F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("code")
    return t.orders.select(code, F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("1")).alias("line"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))


def _second(t):
    code = F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("code")
    line = F.nullif(F.col("l_linenumber").cast("string"), F.lit("1")).alias("line")
    return t.lineitem.select(code, line, F.col("l_extendedprice").alias("price"))


@query("stored_upserts", f"""
with {_STORED_SQL} select coalesce(t.code, u.code) as code, coalesce(t.line, u.line) as line, case when u.price is null or t.price > u.price then t.price else u.price end as price, status
from t full join u on u.code = t.code and u.line is not distinct from t.line
""")
def _(t):
    """Orders stored, then all line items upserted; keys have leading zeros and null parts. The dearer row of a key is the newer one. The second write runs twice."""
    path = scratch_folder(t.spark, "stored-upserts")
    X.upsert_into(path, _first(t), ["code", "line"], buckets=8)
    for _ in range(2):
        X.upsert_into(path, _second(t), ["code", "line"], order=["price"])
    return stored.read_table(t.spark, path)


@query("stored_inserts", f"""
with {_STORED_SQL} select code, line, price, status from t
union all select code, line, price, null from u where not exists (select 1 from t where t.code = u.code and t.line is not distinct from u.line)
""")
def _(t):
    path = scratch_folder(t.spark, "stored-inserts")
    X.insert_new_into(path, _first(t), ["code", "line"], buckets=8)
    for _ in range(2):
        X.insert_new_into(path, _second(t), ["code", "line"], order=["price"])
    return stored.read_table(t.spark, path)
