"""The queries of this package: name -> function of (spark, folder of tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodepulse.llm import (
    bitpack,
    html_blocks,
    lang_mix,
    markov_secrets,
    packing,
    reply_trees,
    simhash_trie,
    spotsigs,
    suffix_pieces,
    term_pipeline,
    topk,
    toxic_crf,
    whitening,
)
from nodepulse.llm.common import read, remainder, vocabulary
from nodepulse.session import scratch_path


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of all documents and of their edited texts."""
    return spotsigs.spotsigs(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each closed by id 1, in sequences of at most 2048 ids."""
    return packing.packed_documents(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1, size=2048)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every 100th vector with all others."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10, scale=1024)


def op4_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; three quarters of them, by a hash of the id, teach."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = lang_mix.train(docs.where(~held_out))
    out = lang_mix.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of a byte-pair SentencePiece vocabulary, and decoded again."""
    path = vocabulary("piece_bpe_32k.model")
    ids = suffix_pieces.encoded(read(spark, sf_dir, "documents").select("doc_id", "text"), path, keep=False)
    return suffix_pieces.decoded(ids, path).drop("text")


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks in control strings, formatted and read back."""
    own = "</s>[INST] ok [/INST]"
    more = spark.sql(f"select * from values (-1L, 0L, 'user', '{own}'), (-1L, 1L, 'assistant', '{own}') t(conv_id, turn, role, text)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    out = reply_trees.conversations(reply_trees.linear(rows), unique=True)
    said = reply_trees.turns_of(F.col("formatted"))
    out = out.withColumn("turns", said).withColumn("learned", reply_trees.loss_text(F.col("formatted"), F.col("loss")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as bit-packed ids in files, read back."""
    folder = scratch_path(spark, "tokens")
    manifest = bitpack.write_token_files(read(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    return bitpack.read_token_files(spark, manifest)


def op8_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; four fifths of the labels, by a hash of the id, teach."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 5) == 0
    model = toxic_crf.train(docs, read(spark, sf_dir, "labels").where(~held_out))
    out = toxic_crf.predict(docs.withColumn("held_out", held_out), model)
    return out.select("doc_id", "held_out", "score", "predicted", "spans")


def op9_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_blocks.main_text(pages, html_blocks.train(pages))


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of all documents."""
    found = simhash_trie.near_components(read(spark, sf_dir, "documents"), limit=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return term_pipeline.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


def op12_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts and places of the patterns' spans, and all spans."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = markov_secrets.secrets(docs, markov_secrets.train(docs)).drop("text")

    def places(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    kinds = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return out.select("doc_id", *kinds, F.sha2(places(base), 256).alias("base_sha256"), places(F.col("secrets")).alias("spans"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 32 whitened components of all vectors."""
    return whitening.whitened(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), most=32, scale=64, plus=1_000_000)


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_packing": op2_packing,
    "op3_topk": op3_topk,
    "op4_language_mix": op4_language_mix,
    "op5_suffix_pieces": op5_suffix_pieces,
    "op6_reply_trees": op6_reply_trees,
    "op7_bit_packing": op7_bit_packing,
    "op8_toxic_crf": op8_toxic_crf,
    "op9_html_blocks": op9_html_blocks,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_term_pipeline": op11_term_pipeline,
    "op12_markov_secrets": op12_markov_secrets,
    "op13_whitening": op13_whitening,
}

#: SQL for the same rows, where SQL can say it.
SQL: dict[str, str] = {
    "op6_reply_trees": """
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
),
e as (
    select *, regexp_replace(replace(text, chr(92), repeat(chr(92), 2)), '<([|]|/?s>|</?SYS>>)', '<' || chr(92) || chr(92) || '\\1', 'g') as half
    from c
),
f as (
    select *, length(regexp_replace(half, '\\[(/?INST\\])', '[' || chr(92) || chr(92) || '\\1', 'g')) as n from e
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(role) + n + 24)::bigint as formatted_chars
from f group by conv_id
""",
    "op3_topk": """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
    from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 100 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, cast(score as bigint) as score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 10
""",
    "op11_term_pipeline": r"""
with d as (
    select row_number() over () as d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
    from documents
),
whole as (select count(*) filter (len(t) > 0)::bigint as n, sum(len(t))::bigint as l from d),
tf as (select d, doc_id, term, len(t)::bigint as n, count(*)::bigint as tf from (select d, doc_id, t, unnest(t) as term from d) group by all),
asked as (
    select item_id, term, count(*)::bigint as times from (
        select item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark
    ) where item_id is not null group by all
),
weight as (
    select term, cast(floor(1000 * ln((2 * whole.n + 2) / (2 * df + 1))) as bigint) as w
    from (select term, count(*) as df from tf group by term), whole
),
scored as (
    select item_id, d, doc_id, sum(times * w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + (25 * tf.n * whole.n) // whole.l)))) as score
    from asked join weight using (term) join tf using (term), whole
    group by item_id, d, doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 20
""",
}
