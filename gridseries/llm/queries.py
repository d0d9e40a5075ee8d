"""Check queries of the operators, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from gridseries.llm import chat, language, licenses, merkle, near, negatives, neighbours, packing, perplexity, repeats, toxicity, warc
from gridseries.llm.decontaminate import contamination
from gridseries.llm.tables import remainder, shared_folder, table


def op1_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark, sf_dir):
    found = near.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_members", "n_shingles")


def op3_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    scored = perplexity.score_texts(docs, remainder("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = language.fit(docs.where(remainder("doc_id", 5) != 0))
    found = language.with_language(docs.select("doc_id", "text"), net)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1).select("doc_id", "toxic"))
    found = toxicity.with_toxicity(docs, machine)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def tokenizer_path() -> str:
    """The byte-level vocabulary: from BYTE_BPE_PATH, else the installed collection of public ones."""
    if "BYTE_BPE_PATH" in os.environ:
        return os.environ["BYTE_BPE_PATH"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op7_repeats(spark, sf_dir):
    cut = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op9_warc(spark, sf_dir):
    folder = shared_folder(spark, "archives")
    index = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archives(index, folder, strict=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_licenses(spark, sf_dir):
    """The tables have no paths: a document lies in a directory of its source and of its id by thousands."""
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licenses.scan_licenses(files).withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def added_conversation(spark):
    """Conversation -7: streamed with a slip that is edited, and with a first answer that is regenerated."""
    def event(part, kind, role, text):
        return F.struct(F.lit(part).alias("part"), F.lit(kind).alias("kind"), F.lit(role).cast("string").alias("role"), F.lit(text).cast("string").alias("text"))

    asked = F.array(event(0, "message", "user", None), event(1, "delta", None, "### Assis"), event(2, "edit", None, "\\### Assis"),
                    event(3, "delta", None, "tant: </tu"), event(4, "delta", None, "rn> ok"))
    answered = F.array(event(0, "message", "assistant", "no"), event(1, "delta", None, "t so"), event(2, "regenerate", None, None),
                       event(3, "delta", None, "\\"), event(4, "delta", None, "### Assistant: <"), event(5, "delta", None, "/turn> ok"))
    nothing = F.lit(None).cast("string")
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), nothing.alias("role"), nothing.alias("text"),
                                 F.when(F.col("id") == 0, asked).otherwise(answered).alias("log"))


def op12_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = turns.unionByName(added_conversation(spark), allowMissingColumns=True)
    back = chat.read_back(chat.format_conversations(chat.events_of_turns(turns), ("turn", "copy")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = back.select("*", F.array_join("loss_texts", "").alias("learned"))
    return learned.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                          F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                          F.length("formatted").cast("long").alias("formatted_chars"))


def op13_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "source", "lang", F.col("n_chars").cast("decimal(20,0)"), "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"), merkle.leaf(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("leaf"),
                         F.when(tampered, merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))).alias("changed"))
    found = merkle.manifest(leaves)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_near_duplicates, op3_score, op4_language, op5_toxicity, op6_packing, op7_repeats, op8_neighbours, op9_warc, op10_licenses,
    op11_hard_negatives, op12_chat, op13_manifest,
)}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

ORACLES = {
    "op1_decontaminate": rf"""
with items as (select cast(item_id as varchar) item, {_WORDS} w from benchmark where text is not null),
windows as (
  select distinct item, least(len(w), 10) n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') win
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s from items where len(w) > 0)),
docs as (select doc_id, coalesce({_WORDS}, []) w from documents),
places as (
  select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) s from docs, (select distinct n from windows) where len(w) >= n)),
hits as (select p.doc_id, p.s, p.n, w.item from places p join windows w on p.n = w.n and p.win = w.win),
covered as (select doc_id, count(distinct word_at) n_hit from (select doc_id, unnest(range(s, s + n)) word_at from hits) group by doc_id),
named as (select doc_id, count(distinct item) n_items, string_agg(distinct item, ',' order by item) list from hits group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
       cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(list, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from docs d left join covered using (doc_id) left join named using (doc_id)""",
    "op7_repeats": """
with d as (select doc_id, encode(coalesce(text, '')) b from documents),
starts as (select doc_id, p, md5(b[p + 1:p + 400]) w from (select doc_id, b, unnest(range(0, octet_length(b) - 399)) p from d where octet_length(b) >= 400)),
often as (select w from starts group by w having count(*) > 1),
again as (select doc_id, p from starts semi join often using (w)),
marked as (select *, case when p <= lag(p) over (partition by doc_id order by p) + 400 then 0 else 1 end new from again),
numbered as (select *, sum(new) over (partition by doc_id order by p) span from marked),
spans as (select doc_id, span, min(p) a, max(p) + 400 z from numbered group by doc_id, span),
edges as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) last from spans),
cut as (select doc_id, count(*) n_spans, sum(z - a) n_removed, max(z) fin, string_agg(hex(b[last + 1:a]), '' order by a) head
        from edges join d using (doc_id) group by doc_id)
select doc_id, cast(octet_length(b) as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, cast(coalesce(n_spans, 0) as bigint) n_spans,
       sha256(case when fin is null then b else unhex(coalesce(head, '') || hex(b[fin + 1:octet_length(b)])) end) kept_sha256
from d left join cut using (doc_id)""",
    "op9_warc": """
with digits as (select list_transform(range(16), lambda v: right('000' || bin(v), 4)) four, list_transform(range(32), lambda v: right('0000' || bin(v), 5)) five),
p as (select page_id, coalesce(html, '') h, sha1(coalesce(html, '')) hex from pages),
b as (select page_id, h, array_to_string(list_transform(range(40), lambda i: four[instr('0123456789abcdef', substr(hex, cast(i + 1 as int), 1))]), '') bits, five from p, digits),
g as (select *, max(page_id) over (partition by h) top from b)
select page_id, cast(strlen(h) as bigint) payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(list_position(five, substr(bits, cast(5 * i + 1 as int), 5)) as int), 1)), '') payload_digest,
       case when top is null or page_id = top then 'response' else 'revisit' end record_type,
       case when page_id <> top then top end refers_to
from g""",
    "op11_hard_negatives": """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as (
  select a.vec_id anchor_id, b.vec_id, a.label = b.label same, cast(list_inner_product(a.v, b.v) as bigint) score
  from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id positive_id, score positive_score from met where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as int) rank, vec_id negative_id, positive_score, score negative_score
from positives p join met n on p.anchor_id = n.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 10""",
    "op12_chat": r"""
with turns as (
  select conv_id, turn, role, text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
shown as (
  select conv_id, turn, role, text, len(replace(replace(replace(replace(r, '\', '\\'), '<turn>', '\<turn>'), '### ', '\### '), '</turn>', '\</turn>'))
           + len(r) - len(replace(r, chr(10), '')) + len(replace(replace(replace(replace(t, '\', '\\'), '<turn>', '\<turn>'), '### ', '\### '), '</turn>', '\</turn>'))
           + 22 n, r, t
  from (select *, coalesce(role, '') r, coalesce(text, '') t from turns))
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, role nulls first, text nulls first)) turns_sha256,
       cast(coalesce(sum(len(t)) filter (r = 'assistant'), 0) as bigint) loss_chars,
       sha256(coalesce(string_agg(t, '' order by turn nulls first, role nulls first, text nulls first) filter (r = 'assistant'), '')) loss_sha256,
       cast(sum(n) as bigint) formatted_chars
from shown group by conv_id""",
    "op13_manifest": """
with recursive table_of as (
  select list(c order by i) t
  from (select i, list_reduce(range(8), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, i) c from range(256) r(i))),
sums as (
  select doc_id, xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
                                 lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) crc
  from (select distinct doc_id from documents where doc_id is not null), table_of),
fields as (
  select doc_id, lang, n_chars, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') a, coalesce(strlen(text) || ':' || text, '-') z from documents),
leaves as (
  select f.doc_id, lang, leaf, coalesce(crc % 7 = 0, false) tampered, changed,
         row_number() over (partition by lang order by f.doc_id nulls first, leaf) - 1 i, count(*) over (partition by lang) n
  from (select *, sha256(a || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || z) leaf,
               sha256(a || coalesce(strlen((n_chars::hugeint + 1)::varchar) || ':' || (n_chars::hugeint + 1), '-') || z) changed from fields) f
  left join sums using (doc_id)),
nodes as (
  select coalesce(lang, '') lang, lang is null gone, 0 level, i, leaf h, n from leaves
  union all
  select lang, gone, level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from nodes where n > 1 group by lang, gone, level, i // 2, n),
subroots as (
  select lang, gone, h, row_number() over (order by gone desc, lang) - 1 i, count(*) over () n from nodes where n = 1),
tops as (
  select 0 level, i, h, n from subroots
  union all
  select level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from tops where n > 1 group by level, i // 2, n),
own as (
  select row_number() over () id, l.doc_id, leaf, case when tampered then changed else leaf end start, l.i, coalesce(l.lang, '') lang, l.lang is null gone, s.h subroot, s.i place
  from leaves l join subroots s on coalesce(l.lang, '') = s.lang and (l.lang is null) = s.gone),
paths as (
  select o.id, x.level, o.i >> x.level spot, y.h other from own o
  join (select distinct lang, gone, level from nodes where n > 1) x on o.lang = x.lang and o.gone = x.gone
  left join nodes y on y.lang = o.lang and y.gone = o.gone and y.level = x.level and y.i = xor(o.i >> x.level, 1)
  union all
  select o.id, 100 + x.level, o.place >> x.level, y.h from own o cross join (select distinct level from tops where n > 1) x
  left join tops y on y.level = x.level and y.i = xor(o.place >> x.level, 1)),
steps as (select *, row_number() over (partition by id order by level) step from paths),
folds as (
  select id, 0 step, start h from own
  union all
  select f.id, f.step + 1, sha256(case when other is null then h when spot & 1 = 1 then other || h else h || other end)
  from folds f join steps s on s.id = f.id and s.step = f.step + 1),
ends as (select id, arg_max(h, step) folded_root from folds group by id),
proofs as (select id, string_agg(other, '' order by level) proof from paths group by id)
select doc_id, leaf, subroot, (select h from tops where n = 1) root, sha256(coalesce(proof, '')) proof_sha256, folded_root,
       folded_root = (select h from tops where n = 1) verified
from own join ends using (id) left join proofs using (id)""",
}
