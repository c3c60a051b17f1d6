"""One query per operator, with production parameters, over whole tables; and the same question in SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuerlake.llm.alignment import alignment
from issuerlake.llm.counts import document_counts
from issuerlake.llm.decontaminate import contamination
from issuerlake.llm.jaccard import similar_sets
from issuerlake.llm.language import identify, learn
from issuerlake.llm.licenses import license_scan
from issuerlake.llm.mixing import quality_domains, rates
from issuerlake.llm.pairbounds import ranked
from issuerlake.llm.pieces import encode
from issuerlake.llm.search import top_k
from issuerlake.llm.shared import scratch
from issuerlake.llm.substrings import without_repeats
from issuerlake.llm.tokenfiles import roundtrip
from issuerlake.llm.tokens import tokenizer_path
from issuerlake.llm.toxicity import held_out, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION_SQL = rf"""
with d as (select doc_id, coalesce({_WORDS}, []) as w from documents),
i as (select item_id, {_WORDS} as w from benchmark where text is not null),
iw as (select distinct item_id, len(list_slice(w, k, k + 9)) as size, list_slice(w, k, k + 9) as words
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from i where len(w) > 0)),
sizes as (select distinct size from iw),
dw as (select doc_id, k, size, list_slice(w, k, k + size - 1) as words
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k from d, sizes)),
hit as (select distinct doc_id, k, size, item_id from dw join iw using (size, words)),
pos as (select distinct doc_id, unnest(range(k, k + size)) as p from hit),
a as (select doc_id, count(*) as n_hit from pos group by 1),
b as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as items
  from (select distinct doc_id, cast(item_id as varchar) as x from hit) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join a using (doc_id) left join b using (doc_id)"""


@query("op1_decontaminate", CONTAMINATION_SQL)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)


@query("op4_ngram_jaccard")
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return similar_sets(table(spark, folder, "documents"), words=3, percent=90)


REPEATS_SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
k as (select doc_id, p, sha256(array_to_string(list_slice(w, p, p + 12), ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as p from d)),
m as (select h, min(doc_id) as least from k group by h),
g as (select distinct doc_id, unnest(range(p, p + 13)) as p from k join m using (h) where least < doc_id),
x as (select doc_id, p, w[p] as word from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d)),
r as (select x.doc_id, string_agg(word, ' ' order by x.p) as kept, count(*) as n
  from x left join g on x.doc_id = g.doc_id and x.p = g.p where g.p is null group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join r using (doc_id)"""


@query("op5_substring_dedup", REPEATS_SQL)
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"), length=13).drop("kept")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_language")
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
    found = identify(docs, learn(docs.where("not held_out")))
    return found.withColumn("held_out", held_out(F.col("doc_id"), 4, 2)).select("doc_id", "held_out", "lang_pred", "score", "bits", "rejected")


@query("op9_licenses")
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


#: Shares of all tokens that a training mix should have.
WEIGHTS = {"good": 0.9, "poor": 0.09, "toxic": 0.01}
#: The id that ends documents in flat files: the vocabulary's own end of text.
SEPARATOR = 50256


@query("op2_token_files")
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return roundtrip(table(spark, folder, "documents"), scratch(spark, "tokens"), tokenizer_path())


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return document_counts(table(spark, folder, "documents"), scratch(spark, "flat"), tokenizer_path(), SEPARATOR)


@query("op8_mixing")
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return rates(table(spark, folder, "documents"), quality_domains(table(spark, folder, "labels")), WEIGHTS)


@query("op10_search")
def op10_search(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents whose id is divisible by 20, against all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return top_k(docs, docs.where("doc_id % 20 = 0"), k=10)


PIECES = "piece_bpe_32k.model"


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    found = encode(table(spark, folder, "documents"), tokenizer_path(PIECES), decoded=True)
    ids = F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids, F.sha2("decoded", 256).alias("decoded_sha256"))


RANKED_SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents where text is not null),
s as (select count(*) as big_n, sum(len(w)) as big_l from d where len(w) > 0),
q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark where text is not null),
t as (select r, doc_id, len(w) as n, unnest(w) as term from d),
p as (select r, doc_id, n, term, count(*) as tf from t where term in (select term from q) group by all),
f as (select term, cast(floor(1000 * ln((2.0::double * any_value(big_n) + 2) / (2 * count(*) + 1))) as bigint) as weight from p, s group by term),
x as (select q.item_id, p.r, p.doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * cast(big_n as bigint)) // cast(big_l as bigint))))) as bigint) as score
  from p join f using (term) join q using (term), s group by 1, 2, 3),
o as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from x where score > 0)
select item_id, cast(rank as integer) as rank, cast(doc_id as bigint) as doc_id, score from o where rank <= 10"""


@query("op12_ranked_search", RANKED_SQL)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path(PIECES))
