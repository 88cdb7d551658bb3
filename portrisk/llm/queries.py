"""One query for each operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrisk.llm import extraction, fingerprints, jaccard, line_dedup, minmax, mixing, packing, phrases, quality, suffixes, textkit, topk, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    textkit.short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_JACCARD = r"""with w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
  s as (select doc_id, case when len(words) = 0 then []::varchar[] when len(words) < 4 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) end as shingles from w),
  n as (select doc_id, len(shingles) as n_shingles from s),
  g as (select doc_id, unnest(shingles) as shingle from s),
  o as (select a.doc_id as a, b.doc_id as b, count(*) as both_have from g a join g b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
  l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * both_have >= 85 * (x.n_shingles + y.n_shingles - both_have)),
  e as (select a, b from l union all select b, a from l),
  c as (with recursive r(doc_id, seen) as (select doc_id, doc_id from n union select e.b, r.seen from r join e on e.a = r.doc_id where r.seen < e.b)
    select doc_id, min(seen) as component_id from r group by doc_id)
  select n.doc_id, n.n_shingles, c.component_id from n join c using (doc_id)"""


@query("op1_ngram_jaccard_join", _JACCARD)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


# windows of 50 bytes, written as hexadecimal text
_SUFFIXES = """with b as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
  w as (select doc_id, pos, substr(h, 2 * pos + 1, 100) as gram from (select doc_id, h, unnest(range(0, n - 49)) as pos from b)),
  f as (select *, min(doc_id) over (partition by gram) as origin from w),
  g as (select doc_id, pos, coalesce(pos > max(pos + 50) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), true) as fresh
    from f where doc_id > origin),
  i as (select doc_id, min(pos) as head, max(pos) + 50 as tail from (select *, sum(fresh::int) over (partition by doc_id order by pos) as island from g) group by doc_id, island),
  m as (select doc_id, list(struct_pack(head := head, tail := tail) order by head) as spans from i group by doc_id),
  k as (select b.doc_id, n, coalesce(len(spans), 0) as n_spans, coalesce(list_sum(list_transform(spans, lambda s: s.tail - s.head)), 0) as n_removed,
    case when spans is null then h else substr(h, 1, 2 * spans[1].head) || list_aggregate(list_transform(range(1, len(spans) + 1), lambda x:
      substr(h, 2 * spans[x].tail + 1, 2 * (coalesce(spans[x + 1].head, n) - spans[x].tail))), 'string_agg', '') end as kept from b left join m using (doc_id))
  select doc_id, n as n_bytes, n_removed::bigint as n_removed, n_spans, sha256(from_hex(kept)) as kept_sha256 from k"""


@query("op2_suffix_array_dedup", _SUFFIXES)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents")).drop("text")


_LINES = r"""with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as all_lines, text from documents),
  e as (select doc_id, line, content, len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) as words from
    (select doc_id, unnest(all_lines) as content, generate_subscripts(all_lines, 1) - 1 as line from d)),
  l as (select *, row_number() over (partition by doc_id order by line) as pos, sum(words) over (partition by doc_id order by line) as upto from e where words > 0),
  p as (select a.doc_id, a.pos as head, b.pos as tail from l a join l b on a.doc_id = b.doc_id and b.pos between a.pos and a.pos + 19 and b.upto - a.upto + a.words >= 20),
  w as (select doc_id, head, min(tail) as tail from p group by all union select doc_id, max(head), tail from p group by doc_id, tail),
  r as (select w.doc_id, w.head, w.tail, string_agg(content, chr(10) order by l.pos) as run from w join l on l.doc_id = w.doc_id and l.pos between w.head and w.tail group by all),
  f as (select *, min({'d': doc_id, 'h': head}) over (partition by run) as origin from r),
  g as (select distinct l.doc_id, l.line from f join l on l.doc_id = f.doc_id and l.pos between f.head and f.tail where {'d': f.doc_id, 'h': f.head} > f.origin),
  k as (select e.doc_id, coalesce(string_agg(content, chr(10) order by e.line) filter (g.line is null), '') as kept, count(g.line) as n_deleted
    from e left join g on g.doc_id = e.doc_id and g.line = e.line group by all)
  select d.doc_id, case when d.text is not null then kept end as text, case when d.text is null then 0 else len(all_lines) end as n_lines, n_deleted from d join k using (doc_id)"""


@query("op3_line_dedup", _LINES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, quality.graded(table(spark, sf_dir, "labels"))))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_words(table(spark, sf_dir, "documents"), tokenizer_path())


_WHOLE = "list_transform(embedding, lambda x: floor(x::double * 256))"


@query(
    "op7_exact_top_k",
    f"""with v as (select vec_id, {_WHOLE} as e from embeddings where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
    select query_id, rank, vec_id, score from r where rank <= 5""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    vectors = vectors.select("vec_id", topk.integers(F.col("embedding")).alias("embedding"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_document_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


_MIX = r"""with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as hash from documents),
  s as (select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) - 1 as place from d group by source),
  w as (select *, (place % 3 + 1)::double as weight, source_size * 3.0::double as most, sum(source_size) over ()::double as total from s),
  o as (select *, most / weight as ratio, coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by most / weight desc, place desc) as after from w),
  l as (select coalesce(arg_min((total - before) / after, ratio) filter ((total - before) / after < ratio), 0) as level from o),
  t as (select source, place, source_size, least(most, weight * level) as target from o, l),
  u as (select *, case when source_size > 0 then least(floor(target / source_size + 1e-12), 3)::bigint else 0 end as full_copies from t),
  n as (select *, greatest(0, target - full_copies * source_size) as need from u),
  h as (select d.source, hash, sum(size) as in_hash from d group by all),
  c as (select *, sum(in_hash) over (partition by source order by hash) as upto from h),
  g as (select c.source, c.hash, need > 0 and full_copies < 3 and (upto <= need or (upto - in_hash < need and (need - (upto - in_hash)) * 2 > in_hash)) as more
    from c join n on n.source is not distinct from c.source)
  select d.doc_id, d.source, d.size, n.source_size, round(n.target, 6) as target, n.full_copies + g.more::bigint as copies, d.size * (n.full_copies + g.more::bigint) as taken
  from d join n on n.source is not distinct from d.source join g on g.source is not distinct from d.source and g.hash = d.hash"""


@query("op10_mixing", _MIX)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


_PHRASES = r"""with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
  w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words from p),
  g1 as (select lang, word, count(*) as f from (select lang, unnest(words) as word from w) group by all),
  g2 as (select lang, two.x as x, two.y as y, count(*) as f from (select lang, unnest(list_transform(range(1, len(words)),
    lambda i: {'x': words[i], 'y': words[i + 1]})) as two from w) group by all),
  g3 as (select lang, three.x as x, three.y as y, three.z as z, count(*) as f from (select lang, unnest(list_transform(range(1, len(words) - 1),
    lambda i: {'x': words[i], 'y': words[i + 1], 'z': words[i + 2]})) as three from w) group by all),
  c as (select g2.lang, g2.x || ' ' || g2.y as phrase, g2.f as a, [{'k': 1, 'l': u.f, 'r': v.f}] as cuts from g2
      join g1 u on u.lang = g2.lang and u.word = g2.x join g1 v on v.lang = g2.lang and v.word = g2.y
      where g2.f >= 10 and not exists (select 1 from g3 where g3.lang = g2.lang and g3.f >= 10 and 100 * g3.f >= 50 * g2.f
        and (g3.x = g2.x and g3.y = g2.y or g3.y = g2.x and g3.z = g2.y))
    union all select g3.lang, g3.x || ' ' || g3.y || ' ' || g3.z, g3.f, [{'k': 1, 'l': u.f, 'r': t.f}, {'k': 2, 'l': s.f, 'r': v.f}] from g3
      join g1 u on u.lang = g3.lang and u.word = g3.x join g1 v on v.lang = g3.lang and v.word = g3.z
      join g2 s on s.lang = g3.lang and s.x = g3.x and s.y = g3.y join g2 t on t.lang = g3.lang and t.x = g3.y and t.y = g3.z where g3.f >= 10),
  s as (select lang, phrase, a, cut.k as k, cut.l as l, cut.r as r, (1000000::hugeint * a * a // (cut.l::hugeint * cut.r))::bigint as score
    from (select lang, phrase, a, unnest(cuts) as cut from c)),
  b as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) as place from s) where place = 1),
  o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
  select lang, rank, phrase, a, l, r, (select sum(f)::bigint from g1 where g1.lang = o.lang) as n, score from o where rank <= 2000"""


@query("op12_phrase_collocations", _PHRASES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


_NEAR = _JACCARD.replace("len(words) < 4", "len(words) < 5").replace("len(words) - 2", "len(words) - 3").replace("i + 3", "i + 4")


@query("op13_minhash_near_dedup", f"select doc_id, n_shingles, component_id, doc_id = component_id as kept from ({_NEAR})")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))
