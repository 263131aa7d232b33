"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from evallens.llm import ann, chat, embed_dedup, license_scan, mixing, ngram_join, packing, prefix_trie, repair, sharding, substring_dedup, toxicity, warc


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_toxicity(spark, d):
    scored = toxicity.toxicity(_read(spark, d, "documents"), _read(spark, d, "labels"))
    return scored.select("doc_id", "severity", "grade", "p_toxic", "rejected")


def op2_ngram_join(spark, d):
    return ngram_join.ngram_join(_read(spark, d, "documents"), n=3, num=90, den=100)


def op3_nearest(spark, d):
    vectors = _read(spark, d, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op5_embedding_dedup(spark, d):
    return embed_dedup.embedding_dedup(_read(spark, d, "embeddings"), cosine=0.98)


def op4_sharding(spark, d):
    return sharding.shard(_read(spark, d, "documents"), shards=40)


def op6_packing(spark, d):
    return packing.pack(_read(spark, d, "documents"), max_tokens=2048, buckets=8, batch_tokens=16384)


def document_files(docs):
    """Documents as a file tree: /source/lang/hundreds/tens/name; each folder of sixteen
    files has a licence file, and so has each folder of sixteen such folders."""
    part = lambda c: F.coalesce(F.col(c), F.lit("none"))
    i = F.coalesce(F.col("doc_id"), F.lit(-1))
    upper = F.concat_ws("/", F.lit(""), part("source"), part("lang"), F.shiftright(i, 8).cast("string"))
    lower = F.concat_ws("/", upper, F.shiftright(i, 4).cast("string"))
    path = F.when(i % 256 == 0, F.concat(upper, F.lit("/LICENSE"))).when(i % 16 == 0, F.concat(lower, F.lit("/LICENSE"))).otherwise(
        F.concat(lower, F.lit("/"), i.cast("string"), F.lit(".txt")))
    return docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


def op7_license_scan(spark, d):
    files = license_scan.scan(document_files(_read(spark, d, "documents")))
    return files.withColumnRenamed("file_id", "doc_id")


def op8_mix_sources(spark, d):
    m = mixing.mix(_read(spark, d, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "source")


# A conversation that quotes the template's own control strings.
QUOTING = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark, d):
    conv = _read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    conv = conv.unionByName(spark.createDataFrame(QUOTING, conv.schema))
    return chat.read_chat(chat.format_chat(conv))


def op10_warc(spark, d):
    archives = warc.write_warc(_read(spark, d, "pages"))
    return warc.page_records(warc.read_warc(archives, payloads=False))


def op11_conversation_repair(spark, d):
    conv = _read(spark, d, "conversations")
    facts, edits = repair.repair(repair.damage(conv))
    digest = repair.digests(edits)
    every = conv.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for t, name in ((facts, "_f"), (digest, "_d")):
        every = every.join(t.withColumnRenamed("conv_id", name), F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_substring_dedup(spark, d):
    kept = substring_dedup.remove_repeats(_read(spark, d, "documents"), window=50, base=25)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(_read(spark, d, "conversations"))).drop("node")


QUERIES = {
    "op13_prefix_trie": op13_prefix_trie,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op1_toxicity": op1_toxicity,
    "op7_license_scan": op7_license_scan,
    "op4_sharding": op4_sharding,
    "op6_packing": op6_packing,
    "op3_nearest": op3_nearest,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op10_warc": op10_warc,
    "op8_mix_sources": op8_mix_sources,
    "op9_chat_format": op9_chat_format,
}


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# The dynamic programme, one step per bucket: d<k>(j, cost) is the least padding of the
# first j distinct lengths in k buckets, i the length at which the last bucket starts.
_STEPS = ",\n".join(
    f"d{k} AS (SELECT c.j, min(d.cost + c.cost) AS cost, arg_min(c.i, (d.cost + c.cost, c.i)) AS i "
    f"FROM d{k - 1} d JOIN cost c ON c.i = d.j GROUP BY c.j)" for k in range(2, 9))
_BACK = ",\n".join(f"e{k} AS (SELECT d.i AS j, d.j AS last FROM d{k} d JOIN e{k + 1} e ON e.j = d.j)" for k in range(8, 0, -1))

_TEMPLATES = ",\n".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(license_scan.TEMPLATES))

# crc32 of the ASCII string `s`, bit by bit.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)")


def _then(state: str, cost: str, letter: str, when: str = "TRUE") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {letter}}} END"


def _turn(state: str, initial: str) -> str:
    """A row that becomes the turn a state asks for: kept if it is one, else rewritten."""
    return _then(state, f"CASE WHEN i = '{initial}' THEN late ELSE 2 + late END", f"CASE WHEN i = '{initial}' THEN 'K' ELSE 'R' END", "stays")


_REPAIR_STEP = f"""
  SELECT conv_id, k, n0 AS s0, n1 AS s1, m2 AS s2, list_min([n3, {_then('m2', '2', "'I'")}]) AS s3 FROM (
    SELECT *, list_min([n2, {_then('n0', '2', "'I'")}, {_then('n1', '2', "'I'")}, {_then('n3', '2', "'I'")}]) AS m2 FROM (
      SELECT r.conv_id, r.k, {_then('s0', '3', "'D'")} AS n0,
             list_min([{_then('s1', '3', "'D'")}, {_then('s0', 'late', "'K'", "stays AND i = 's'")}]) AS n1,
             list_min([{_then('s2', '3', "'D'")}, {_turn('s0', 'u')}, {_turn('s1', 'u')}, {_turn('s3', 'u')}]) AS n2,
             list_min([{_then('s3', '3', "'D'")}, {_turn('s2', 'a')}]) AS n3
      FROM v JOIN r ON r.conv_id = v.conv_id AND r.k = v.k + 1))"""

ORACLE = {
    "op13_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id::VARCHAR AS s, count(*) AS n FROM t GROUP BY conv_id),
plan AS (SELECT conv_id, n, conv_id - conv_id % 5 AS donor, {_CRC} % 9 AS h FROM ids),
path AS (
  SELECT p.conv_id, t.pos AS depth, role, text FROM plan p JOIN t ON t.conv_id = p.donor WHERE pos <= h
  UNION ALL
  SELECT p.conv_id, pos - p.h + least(p.h, coalesce(d.n, 0)), role, text
  FROM plan p JOIN t ON t.conv_id = p.conv_id LEFT JOIN ids d ON d.conv_id = p.donor WHERE pos > p.h),
pre AS (
  SELECT conv_id, depth, strlen(text) AS bytes, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
           PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM path
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
steps AS (SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last FROM pre WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
node AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM steps GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
sub AS (SELECT DISTINCT a.node AS top, b.node FROM steps a JOIN steps b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT top, sum((n_convs - 1) * bytes) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM sub JOIN node USING (node) LEFT JOIN kids USING (node) GROUP BY top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN sums ON top = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN node p ON p.node = n.parent""",
    "op11_conversation_repair": f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, k, role[1] AS i,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1] AS pair FROM placed),
r AS (SELECT *, (fault = 'truncated')::BIGINT AS late, fault NOT IN ('blank', 'duplicate') AS stays FROM faults),
v AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
         {{'c': 2::BIGINT, 'a': 'I'}} AS s2, {{'c': 4::BIGINT, 'a': 'II'}} AS s3 FROM conversations
  UNION ALL {_REPAIR_STEP}),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM r GROUP BY conv_id),
best AS (SELECT conv_id, list_min([s0, s3]) AS b FROM v JOIN facts USING (conv_id) WHERE v.k = n),
letters AS (SELECT conv_id, generate_series AS p, b.a[generate_series] AS e FROM best, generate_series(1, len(b.a))),
marked AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS k, count(*) FILTER (e <> 'D') OVER w - 1 AS place FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
turns AS (
  SELECT m.*, r.role, CASE WHEN e = 'I' THEN '' ELSE r.text END AS text,
         max(CASE WHEN place = 0 AND e = 'K' AND r.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS lead
  FROM marked m LEFT JOIN r ON r.conv_id = m.conv_id AND r.k = m.k AND e <> 'I'),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS h
  FROM turns WHERE e <> 'D' GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN repaired USING (conv_id)""",
    "op12_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, generate_subscripts(h, 1) AS s, unnest(h) AS h FROM (
    SELECT doc_id, list_transform(range(1, greatest(1, len(w) - 48)), lambda s: md5(array_to_string(w[s:s + 49], ' '))) AS h FROM d)),
firsts AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN firsts USING (h) WHERE doc_id > lo),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d),
kept AS (
  SELECT doc_id, count(g.p) AS n_removed, string_agg(x, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL) AS t
  FROM words w LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_license_scan": f"""
WITH parts AS (
  SELECT doc_id, text, '/' || coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/' || (coalesce(doc_id, -1) >> 8) AS up,
         (coalesce(doc_id, -1) >> 4) AS low FROM documents),
files AS (
  SELECT doc_id, text, CASE WHEN doc_id % 256 = 0 THEN up ELSE up || '/' || low END AS dir, up, doc_id % 16 = 0 AS is_license,
         CASE WHEN doc_id % 256 = 0 THEN up || '/LICENSE' WHEN doc_id % 16 = 0 THEN up || '/' || low || '/LICENSE'
              ELSE up || '/' || low || '/' || coalesce(doc_id, -1) || '.txt' END AS path FROM parts),
lines AS (
  SELECT doc_id, path, generate_subscripts(string_split(text, chr(10)), 1) AS seg, unnest(string_split(text, chr(10))) AS s FROM files
  UNION ALL SELECT doc_id, path, 0, text FROM files WHERE is_license AND len(string_split(text, chr(10))) > 1),
words AS (
  SELECT doc_id, path, seg, [x FOR x IN regexp_split_to_array(lower(s), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w FROM lines),
seg AS (SELECT * FROM words WHERE len(w) > 0),
tpl(i, license, t) AS (VALUES {_TEMPLATES}),
tt AS (SELECT i, license, unnest([x FOR x IN regexp_split_to_array(lower(t), '[^\\p{{L}}\\p{{N}}]+') IF x <> '']) AS term FROM tpl),
ttf AS (SELECT i, license, term, count(*) AS tf FROM tt GROUP BY ALL),
total AS (SELECT count(*) AS n FROM seg),
flat AS (SELECT doc_id, path, seg, unnest(w) AS term FROM seg),
tf AS (SELECT doc_id, path, seg, term, count(*) AS tf FROM flat GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT t.term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT term FROM ttf UNION SELECT term FROM df) t CROSS JOIN total LEFT JOIN df USING (term)),
tw AS (SELECT i, license, term, (1 + ln(tf)) * idf AS w FROM ttf JOIN idf USING (term)),
tn AS (SELECT i, sqrt(sum(w * w)) AS norm FROM tw GROUP BY i),
sw AS (SELECT doc_id, path, seg, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)),
sn AS (SELECT doc_id, path, seg, sqrt(sum(w * w)) AS norm FROM sw GROUP BY ALL),
cos AS (
  SELECT s.doc_id, s.path, s.seg, t.i, t.license, round(sum(s.w * t.w / tn.norm) / any_value(sn.norm), 6) AS score
  FROM sw s JOIN tw t USING (term) JOIN tn ON tn.i = t.i JOIN sn ON sn.path = s.path AND sn.seg = s.seg AND sn.doc_id = s.doc_id
  GROUP BY ALL),
own AS (SELECT doc_id, path, arg_min(license, (-score, license)) AS own_license, max(score) AS own_score FROM cos WHERE score >= 0.6 GROUP BY ALL),
dirs AS (SELECT f.dir, arg_min(o.own_license, (-o.own_score, o.own_license)) AS license FROM files f JOIN own o USING (doc_id, path) WHERE is_license GROUP BY f.dir)
SELECT f.doc_id, f.path, own_license, own_score, coalesce(own_license, a.license, b.license) AS license,
       CASE WHEN own_license IS NULL THEN CASE WHEN a.license IS NOT NULL THEN f.dir WHEN b.license IS NOT NULL THEN f.up END END AS license_dir
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id AND o.path = f.path LEFT JOIN dirs a ON a.dir = f.dir LEFT JOIN dirs b ON b.dir = f.up""",
    "op6_packing": f"""
WITH docs AS (SELECT doc_id, {_WORDS}::BIGINT AS n FROM documents),
piece AS (SELECT doc_id, n, unnest(range(0, greatest(1, (n + 2047) // 2048)))::BIGINT AS piece FROM docs),
seqs AS (SELECT doc_id, piece, least(2048, n - piece * 2048)::BIGINT AS n_tokens,
              substr(md5('pack|' || coalesce(doc_id::VARCHAR, chr(0)) || '|' || piece), 1, 16) AS k FROM piece),
hist AS (SELECT n_tokens AS len, count(*) AS c FROM seqs WHERE n_tokens > 0 GROUP BY n_tokens),
h AS (SELECT row_number() OVER w AS j, len, sum(c) OVER w AS seqs, sum(c * len) OVER w AS toks FROM hist WINDOW w AS (ORDER BY len)),
h0 AS (SELECT 0 AS j, 0 AS len, 0 AS seqs, 0 AS toks UNION ALL SELECT * FROM h),
cost AS (SELECT a.j AS i, b.j, b.len * (b.seqs - a.seqs) - (b.toks - a.toks) AS cost FROM h0 a JOIN h b ON a.j < b.j),
d1 AS (SELECT j, cost, i FROM cost WHERE i = 0),
{_STEPS},
e9 AS (SELECT max(j) AS j, 0 AS last FROM h),
{_BACK},
ends AS (SELECT len, row_number() OVER (ORDER BY len) - 1 AS bucket FROM h JOIN (
  {" UNION ".join(f"SELECT last FROM e{k}" for k in range(1, 9))}) e ON h.j = e.last),
b AS (SELECT s.*, e.bucket, e.len AS bucket_len FROM seqs s ASOF LEFT JOIN ends e ON s.n_tokens <= e.len AND s.n_tokens > 0),
p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY k, doc_id, piece, n_tokens) - 1 AS pos,
             greatest(1, 16384 // bucket_len) AS per FROM b)
SELECT doc_id, piece, n_tokens, bucket::INT AS bucket, bucket_len, CASE WHEN bucket IS NOT NULL THEN pos // per END AS batch,
       CASE WHEN bucket IS NOT NULL THEN pos % per END AS place
FROM p""",
    "op5_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true) AS bad FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND NOT bad),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
       least(vec_id, coalesce(l.b, vec_id)) = vec_id AS kept
FROM v LEFT JOIN least_id l ON l.a = vec_id LEFT JOIN degree g ON g.a = vec_id""",
    "op2_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [hash(w[i], w[i + 1], w[i + 2]) FOR i IN range(1, len(w) - 1)]
                                      WHEN len(w) > 0 THEN [hash(len(w), w)] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sn AS (SELECT s.doc_id, s.g, n.n FROM s JOIN n USING (doc_id)),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sn a JOIN sn b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id,
       coalesce(g.n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_id l ON l.a = w.doc_id LEFT JOIN degree g ON g.a = w.doc_id""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS winner FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < winner THEN winner END AS refers_to
FROM r""",
    "op8_mix_sources": f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         substr(md5('mix|' || coalesce(doc_id::VARCHAR, chr(0))), 1, 16) AS k
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM base GROUP BY source),
fill(round, held, num, den) AS (
  SELECT 0, -1::BIGINT, 0::HUGEINT, 1::HUGEINT
  UNION ALL
  SELECT round + 1, n, 3 * total - 4 * capped, 2 * free FROM (
    SELECT f.round, f.held, count(*) FILTER (f.held >= 0 AND 2 * s.source_size * f.den < f.num * s.w) AS n,
           sum(s.source_size)::HUGEINT AS total,
           coalesce(sum(s.source_size) FILTER (f.held >= 0 AND 2 * s.source_size * f.den < f.num * s.w), 0)::HUGEINT AS capped,
           coalesce(sum(s.w) FILTER (NOT (f.held >= 0 AND 2 * s.source_size * f.den < f.num * s.w)), 0)::HUGEINT AS free
    FROM fill f, src s GROUP BY ALL) WHERE n <> held AND free > 0),
lam AS (SELECT num, den FROM fill ORDER BY round DESC LIMIT 1),
tgt AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, w * num::DOUBLE / den::DOUBLE) AS target FROM src, lam),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END::BIGINT AS epochs FROM tgt),
placed AS (
  SELECT b.*, c.source_size, c.target, c.epochs, floor(target + 0.5)::BIGINT - epochs * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM base b JOIN cut c ON b.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken, source
FROM placed""",
    "op9_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'),
                  '(<)(s>|/s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\]|ROLE=|/ROLE\])', '\1\3!\2\4', 'g')) AS esc,
         lag(role, 1, 'start') OVER w AS state, row_number() OVER w AS n,
         count(*) OVER (PARTITION BY conv_id) AS total
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(esc + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 17 + length(role) END))::BIGINT AS formatted_chars,
       bool_and(CASE state WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
                           WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
         AND max(CASE WHEN n = total THEN role END) = 'assistant' AS valid
FROM t GROUP BY conv_id""",
}
