"""The registered queries of the operators, and the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chunk_dedup import drop_chunks
from tidemark.llm.cover_tree import top_k
from tidemark.llm.exact_dedup import mark_copies
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mix, word_count
from tidemark.llm.mixing_sql import mixing_sql
from tidemark.llm.packing import pack
from tidemark.llm.prefix_trie import prefix_trie, rebuilt, turn_keys
from tidemark.llm.signature_tree import similar_classes
from tidemark.llm.spelling import variants
from tidemark.llm.substring_dedup import drop_repeats
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.toxicity import Classifier, held_out, score, train
from tidemark.llm.unigram import count_tokens
from tidemark.session import BROADCAST_ROWS, fresh_path, has_at_most

_SPACE = r"[\x20\x09-\x0D]+"


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the folder is ``TOKENIZER_DIR`` if that is set."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return mark_copies(_documents(spark, sf_dir))


EXACT_DEDUP_SQL = f"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, sha256(norm) as text_sha256
from t window g as (partition by norm)
"""


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files written of them."""
    path = fresh_path(spark, "llm-token-files")
    write_token_files(_documents(spark, sf_dir), path, tokenizer_file("byte_bpe_50k.json"), end_id=0)
    found = read_token_files(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    placed = pack(_documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), size=2048, end_id=1)
    return digest_pieces(placed)


def digest_pieces(placed: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    crc = F.crc32("ids").alias("ids_crc32")
    return placed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a classifier fitted on the labelled rows that are not held out."""
    docs = _documents(spark, sf_dir)
    rows = score(docs.select("doc_id", "text", held_out("doc_id").alias("held_out")), classifier(spark, docs, sf_dir))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Classifier:
    """The toxicity classifier of the labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id"))
    labels = labels.select("doc_id", F.col("toxic").alias("label"))
    labels = F.broadcast(labels) if has_at_most(labels, BROADCAST_ROWS) else labels
    return train(docs.select("doc_id", "text").join(labels, "doc_id"), "text", "label", "doc_id")


#: The mix of sources that the query and the pipeline make.
MIX = {"max_repeats": 2.0, "block_tokens": 1 << 14, "seed": 9}


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as often as a mix reads them in which no source is repeated more than twice."""
    mixed = mix(_documents(spark, sf_dir), **MIX)
    return mixed.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens"), "epoch", "block", "position")


MIXING_SQL = mixing_sql("documents", **MIX)


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of near duplicates stays."""
    return near_duplicates(_documents(spark, sf_dir), size=5, percent=85)


NEAR_DEDUP_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents),
s as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
reached as (
  select doc_id, doc_id as node from documents union select r.doc_id, l.b from reached r join links l on l.a = r.node)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.node) as component_id, d.doc_id = min(r.node) as kept
from documents d left join n on n.doc_id = d.doc_id join reached r on r.doc_id = d.doc_id group by d.doc_id
"""


def chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses and keeps when runs of repeated content-defined chunks are dropped."""
    found = drop_chunks(_documents(spark, sf_dir), least_run=48)
    return found.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the pieces and scores of a public vocabulary."""
    return count_tokens(_documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
scores as (
  select q.vec_id as query_id, d.vec_id, list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2]))::bigint as score
  from v q join v d on q.vec_id <> d.vec_id and len(q.e) = len(d.e)
  where q.vec_id % 100 = 0)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from scores qualify rank <= 10
"""


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses and keeps when 50-byte strings of earlier documents are removed."""
    found = drop_repeats(_documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


SUBSTRING_DEDUP_SQL = r"""
with d as (select doc_id, encode(coalesce(text, '')) as bytes from documents),
strings as (
  select doc_id, unnest(range(1, octet_length(bytes) - 48)) as place,
         unnest(list_transform(range(1, octet_length(bytes) - 48), lambda i: md5(array_slice(bytes, i, i + 49)))) as string
  from d where octet_length(bytes) >= 50),
first as (select string, min(doc_id) as first from strings group by string),
later as (select doc_id, place from strings join first using (string) where first < doc_id),
byte as (
  select doc_id, unnest(range(1, octet_length(bytes) + 1)) as place,
         unnest(list_transform(range(1, octet_length(bytes) + 1), lambda i: hex(array_slice(bytes, i, i)))) as code
  from d),
covered as (
  select b.doc_id, b.place, b.code,
         coalesce(max(l.place) over (partition by b.doc_id order by b.place rows between 49 preceding and current row), 0) > 0 as gone
  from byte b left join later l on l.doc_id = b.doc_id and l.place = b.place),
runs as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by place), false) as begins from covered)
select d.doc_id, octet_length(any_value(d.bytes)) as n_bytes, count(*) filter (gone) as n_removed, count(*) filter (begins) as n_spans,
       sha256(unhex(coalesce(string_agg(code, '' order by place) filter (not gone), ''))) as kept_sha256
from d left join runs r on r.doc_id = d.doc_id group by d.doc_id
"""


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the conversations, each begun with turns of the first of its hundred."""
    keys = turn_keys(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    conv = F.col("conv_id")
    return prefix_trie(rebuilt(keys, F.crc32(conv.cast("string").cast("binary")) % 6, 5, conv - conv % 100))


#: The table and the loop of the 32-bit cyclic redundancy check, over the hexadecimal bytes of a text.
_CRC_TABLE = """(select list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as crc_table from range(256) r(i))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    step = "lambda c, b: xor(c // 256, crc_table[(xor(c, b) % 256) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


CONVERSATION_TRIE_SQL = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, md5(length(role) || ':' || role || text)) as number from t),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, {_crc32("conv_id::varchar")} % 6 as head
  from (select distinct conv_id from t), {_CRC_TABLE}),
turns as (
  select c.conv_id, 0 as part, number, role, text from convs c join numbered n on n.conv_id = c.base and number <= head
  union all
  select c.conv_id, 1, number, role, text from convs c join numbered n on n.conv_id = c.conv_id and number > head),
member as (
  select conv_id, row_number() over w as depth, list((role, text)) over w as turns, length(text) as points
  from turns window w as (partition by conv_id order by part, number rows unbounded preceding)
  union all select conv_id, 0, [], 0 from convs),
node as (
  select depth, turns, min(conv_id) as conv_id, count(*) as n_convs, any_value(points) as points from member group by depth, turns),
child as (select depth - 1 as depth, turns[:-2] as turns, count(*) as n_children from node where depth > 0 group by all),
above as (
  select m.depth, m.turns, sum((n.n_convs - 1) * n.points)::bigint as saved_tokens, count(*) filter (c.n_children is null) as n_leaves
  from node n join member m on m.conv_id = n.conv_id and m.depth <= n.depth
  left join child c on c.depth = n.depth and c.turns = n.turns group by all),
last as (select conv_id, max(depth) as depth from member group by conv_id),
ends as (
  select depth, turns, string_agg(conv_id::varchar, ',' order by conv_id) as ids from member join last using (conv_id, depth) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, a.n_leaves, a.saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from node n join above a on a.depth = n.depth and a.turns = n.turns
left join child c on c.depth = n.depth and c.turns = n.turns
left join ends e on e.depth = n.depth and e.turns = n.turns
left join node p on p.depth = n.depth - 1 and p.turns = n.turns[:-2] and n.depth > 0
"""


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class under links of similarity 0.8 and more."""
    return similar_classes(_documents(spark, sf_dir), size=5, percent=80)


JACCARD_JOIN_SQL = NEAR_DEDUP_SQL.replace(">= 85 *", ">= 80 *").replace(", d.doc_id = min(r.node) as kept", "")


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of all documents with the forms they are variants of."""
    return variants(_documents(spark, sf_dir), slip_every=97)


SPELLING_VARIANTS_SQL = f"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
  from documents),
counted as (select doc_id, run, count(*) as n from runs group by all),
hashed as (select run, n, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from counted, {_CRC_TABLE}),
words as (
  select case when h % 97 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run) + 2)::bigint) else run end as word,
         sum(n)::bigint as n
  from hashed group by word having length(word) >= 5 and sum(n) >= 3),
places as (select word, n, unnest(range(1, length(word) + 1)) as at from words),
pairs as (
  select a.word, b.word as near, b.n as near_n
  from places a join places b on length(a.word) = length(b.word) and a.at = b.at and a.word <> b.word
    and left(a.word, a.at - 1) || '*' || substr(a.word, a.at + 1) = left(b.word, b.at - 1) || '*' || substr(b.word, b.at + 1)),
shorter as (
  select distinct p.word as long, p.n as long_n, w.word as short, w.n as short_n
  from places p join words w on left(p.word, p.at - 1) || substr(p.word, p.at + 1) = w.word),
near as (
  select * from pairs union all select long, short, short_n from shorter union all select short, long, long_n from shorter),
best as (
  select word, count(*) as n_near, max(near_n) as best_n,
         arg_min(near, (-near_n, encode(near))) as best from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 2 * w.n then best end as form,
         case when best_n >= 2 * w.n then best_n end as form_n
  from words w left join best using (word)),
chain as (
  select word, word as here, 0 as steps from forms
  union all select c.word, f.form, steps + 1 from chain c join forms f on f.word = c.here where f.form is not null)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n
from forms f join (select word, arg_max(here, steps) as root from chain group by word) r using (word)
"""


#: Name: the query, and its SQL if SQL can express it.
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_chunk_dedup": (chunk_dedup, None),
    "op2_top_k": (top_k_search, TOP_K_SQL),
    "op3_exact_dedup": (exact_dedup, EXACT_DEDUP_SQL),
    "op4_token_files": (token_files, None),
    "op5_token_counts": (token_counts, None),
    "op6_toxicity": (toxicity, None),
    "op7_packing": (packing, None),
    "op8_near_dedup": (near_dedup, NEAR_DEDUP_SQL),
    "op9_mixing": (mixing, MIXING_SQL),
    "op10_substring_dedup": (substring_dedup, SUBSTRING_DEDUP_SQL),
    "op11_conversation_trie": (conversation_trie, CONVERSATION_TRIE_SQL),
    "op12_jaccard_join": (jaccard_join, JACCARD_JOIN_SQL),
    "op13_spelling_variants": (spelling_variants, SPELLING_VARIANTS_SQL),
}
