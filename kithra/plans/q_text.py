"""Text cleaning, vocabularies, word-set joins and near-duplicate search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings
from ..operators import setjoin, text
from .registry import Tables, query
from .snippets import h, ip, norm, top

CLEAN = (
    "coalesce(regexp_replace(trim(regexp_replace(regexp_replace(translate(lower({}), '?:,\"[]~*;!(){{}}@$#.-/''', '                    '),"
    " '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g')), '[0-9]+', '<number>', 'g'), '')"
)


@query("normalize_question", f"SELECT doc_id AS id, {CLEAN.format('text')} AS text FROM documents")
def _(t: Tables):
    return t.documents.select("id", strings.normalize_question("text").alias("text"))


@query("normalize_question_pages", f"SELECT page_id AS id, {CLEAN.format('html')} AS text FROM pages")
def _(t: Tables):
    return t("pages").select(F.col("page_id").alias("id"), strings.normalize_question("html").alias("text"))


TURNS = (
    "turns AS (SELECT a.conv_id, a.turn, a.text AS question1, b.text AS question2 FROM conversations a JOIN conversations b"
    " ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"
)


def turns(t: Tables):
    """Consecutive turns of a conversation as a pair."""
    rows = t("conversations").select("conv_id", "turn", "text")
    following = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("question2"))
    return rows.withColumnRenamed("text", "question1").join(following, ["conv_id", "turn"])


@query("pair_corpus", f"WITH {TURNS}, d AS (SELECT DISTINCT {CLEAN.format('question1')} AS q1, {CLEAN.format('question2')} AS q2 FROM turns)"
       " SELECT q1 AS text FROM d UNION ALL SELECT q2 FROM d")
def _(t: Tables):
    return text.build_pair_corpus(turns(t).select("question1", "question2"))[1]


@query("distinct_items", """SELECT text, conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY conv_id, turn) AS r FROM conversations) WHERE r = 1""")
def _(t: Tables):
    rows = t("conversations").select("text", "conv_id", "turn")
    return text.distinct_items(rows, ["text"], ["conv_id", "turn"])


@query("word_counts", f"WITH {TURNS} SELECT conv_id, turn, len(string_split(question1, ' '))::INTEGER AS question1_words, len(string_split(question2, ' '))::INTEGER AS question2_words FROM turns")
def _(t: Tables):
    return text.word_counts(turns(t), ["question1", "question2"]).select("conv_id", "turn", "question1_words", "question2_words")


TOKENS = "tok AS (SELECT doc_id AS id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))"
VOCAB = "voc AS (SELECT word, row_number() OVER (ORDER BY spot.id, spot.pos) AS word_id, n FROM (SELECT word, min({'id': id, 'pos': pos}) AS spot, count(*) AS n FROM tok WHERE word <> '' GROUP BY word))"


@query("vocabulary", f"WITH {TOKENS}, {VOCAB} SELECT word, word_id, n AS occurrences FROM voc")
def _(t: Tables):
    return text.vocab_fit(t.documents)


@query("vocabulary_ids", f"""WITH {TOKENS}, {VOCAB}, k AS (SELECT id, word, row_number() OVER (PARTITION BY id ORDER BY pos) AS r FROM tok WHERE word <> ''),
  c AS (SELECT id, list(coalesce(word_id, 0) ORDER BY r) AS ids FROM k LEFT JOIN voc USING (word) WHERE r <= 16 GROUP BY id)
  SELECT id, list_concat(ids, list_transform(generate_series(1, 16 - len(ids)), lambda i: 0::BIGINT)) AS ids FROM c""")
def _(t: Tables):
    return text.vocab_transform(t.documents, text.vocab_fit(t.documents))


@query("vocabulary_metadata", f"WITH {TOKENS}, {VOCAB} SELECT word_id::VARCHAR || chr(9) || word AS line FROM voc")
def _(t: Tables):
    return text.vocab_fit(t.documents).select(F.concat_ws("\t", "word_id", "word").alias("line"))


@query("pack_pair_tokens", f"""WITH {TURNS}, s AS (SELECT conv_id, turn, string_split(question1, ' ') AS a, string_split(question2, ' ') AS b FROM turns),
  l AS (SELECT *, CASE WHEN len(a) + len(b) <= 29 THEN len(a) ELSE least(len(a), greatest(29 - len(b), 15)) END AS la,
    CASE WHEN len(a) + len(b) <= 29 THEN len(b) ELSE least(len(b), greatest(29 - len(a), 14)) END AS lb FROM s)
  SELECT conv_id, turn, list_concat(['[CLS]'], a[1:la], ['[SEP]'], b[1:lb], ['[SEP]']) AS tokens,
   list_transform(generate_series(1, 32), lambda i: CASE WHEN i > la + 2 AND i <= la + lb + 3 THEN 1 ELSE 0 END) AS type_ids,
   list_transform(generate_series(1, 32), lambda i: CASE WHEN i <= la + lb + 3 THEN 1 ELSE 0 END) AS mask FROM l""")
def _(t: Tables):
    rows = turns(t).select("conv_id", "turn", strings.words("question1").alias("a"), strings.words("question2").alias("b"))
    return text.pack_pair_tokens(rows, "a", "b", 32).select("conv_id", "turn", "tokens", "type_ids", "mask")


BASE64 = "s AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN base64(encode(text)) ELSE text END AS s FROM documents)"


@query("is_base64", f"""WITH {BASE64} SELECT id, coalesce(regexp_full_match(s, '([A-Za-z0-9+/]{{4}})*([A-Za-z0-9+/]{{2}}==|[A-Za-z0-9+/]{{3}}=)?')
   AND base64(TRY(from_base64(s))) = s, false) AS valid FROM s""")
def _(t: Tables):
    mixed = F.when(F.col("id") % 2 == 0, F.base64(F.col("text").cast("binary"))).otherwise(F.col("text"))
    return t.documents.select("id", strings.is_base64(mixed).alias("valid"))


@query("decode_base64", "SELECT doc_id AS id, text FROM documents")
def _(t: Tables):
    coded = F.base64(F.col("text").cast("binary"))
    return t.documents.select("id", strings.decode_base64(coded).cast("string").alias("text"))


@query("dedup_lines", "SELECT min(doc_id) AS id, text, lower(text) AS lemma FROM documents GROUP BY text")
def _(t: Tables):
    lemma = t.documents.select("id", F.lower("text").alias("lemma"))
    texts, lemmas = text.dedup_lines(t.documents, [lemma])
    return texts.join(lemmas, "id").select("id", "text", "lemma")


# ------------------------------------------------------------------ word sets

SETS = (
    "s0 AS (SELECT doc_id AS id, list_sort(list_distinct(string_split(text, ' '))) AS w FROM documents),"
    " sets AS (SELECT min(id) AS id, w, count(*) AS copies FROM s0 GROUP BY w),"
    " wrd AS (SELECT id, unnest(w) AS word, len(w) AS n FROM sets)"
)
INTER = "inter AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM wrd a JOIN wrd b ON a.word = b.word AND a.id < b.id GROUP BY a.id, b.id)"


def _jaccard_sql(t):
    return f"SELECT a, b, c::DOUBLE / (na + nb - c) AS jaccard FROM inter WHERE c::DOUBLE / (na + nb - c) > {t}"


@query("distinct_word_sets", f"WITH {SETS} SELECT id AS set_id, copies, len(w)::INTEGER AS size FROM sets")
def _(t: Tables):
    sets, _ = setjoin.distinct_sets(t.documents)
    return sets.select("set_id", "copies", F.size("words").alias("size"))


@query("word_set_members", f"WITH {SETS} SELECT sets.id AS set_id, s0.id FROM s0 JOIN sets USING (w)")
def _(t: Tables):
    return setjoin.distinct_sets(t.documents)[1]


@query("jaccard_join", f"WITH {SETS}, {INTER} {_jaccard_sql(0.5)}")
def _(t: Tables):
    return setjoin.jaccard_join(t.documents, None, 0.5)


@query("jaccard_join_two_tables", """WITH b0 AS (SELECT item_id AS id, list_sort(list_distinct(string_split(text, ' '))) AS w FROM benchmark),
  d0 AS (SELECT doc_id AS id, list_sort(list_distinct(string_split(text, ' '))) AS w FROM documents),
  l AS (SELECT min(id) AS id, w FROM b0 GROUP BY w), r AS (SELECT min(id) AS id, w FROM d0 GROUP BY w)
  SELECT l.id AS a, r.id AS b, len(list_intersect(l.w, r.w))::DOUBLE / (len(l.w) + len(r.w) - len(list_intersect(l.w, r.w))) AS jaccard
  FROM l, r WHERE jaccard > 0.1""")
def _(t: Tables):
    asked = t("benchmark").select(F.col("item_id").alias("id"), "text")
    return setjoin.jaccard_join(asked, t.documents, 0.1)


def _perm_sql(n):
    return (
        f"perm AS (SELECT i, 1 + {h(chr(39) + 'a' + chr(39), 'i')} % 2147483646 AS a, {h(chr(39) + 'b' + chr(39), 'i')} % 2147483647 AS b FROM generate_series(0, {n - 1}) g(i))"
    )


def _sig_sql(n):
    return (
        f"{_perm_sql(n)}, hw AS (SELECT id, (('0x'||substr(md5(word),1,8))::BIGINT & 2147483647) AS hv FROM wrd),"
        " mins AS (SELECT id, i, min((a * hv + b) % 2147483647) AS m FROM hw, perm GROUP BY id, i),"
        " sig AS (SELECT id, list(m ORDER BY i) AS signature FROM mins GROUP BY id)"
    )


@query("minhash_signature", f"WITH {SETS}, {_sig_sql(256)} SELECT id AS set_id, signature FROM sig")
def _(t: Tables):
    sets, _ = setjoin.distinct_sets(t.documents)
    return setjoin.minhash_signature(sets).select("set_id", "signature")


BANDS, ROWS = setjoin.band_layout(0.5, 128)


@query("minhash_lsh_join", f"""WITH {SETS}, {_sig_sql(128)}, band AS (SELECT id, g.i AS band, signature[g.i*{ROWS}+1 : g.i*{ROWS}+{ROWS}] AS part FROM sig JOIN sets USING (id), generate_series(0, {BANDS - 1}) g(i)),
  cand AS (SELECT DISTINCT a.id AS a, b.id AS b FROM band a JOIN band b ON a.band = b.band AND a.part = b.part AND a.id < b.id),
  {INTER} SELECT * FROM ({_jaccard_sql(0.5)}) JOIN cand USING (a, b)""")
def _(t: Tables):
    return setjoin.minhash_lsh_join(t.documents, None, 0.5, n_perm=128)


LEMMA = (
    "src AS (SELECT doc_id AS id, text, list_distinct(string_split(text, ' ')) AS w, list_distinct(string_split(lower(text), ' ')) AS lw FROM documents),"
    " lw AS (SELECT id, unnest(lw) AS word, len(lw) AS n FROM src), tw AS (SELECT id, unnest(w) AS word, len(w) AS n FROM src),"
    " li AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM lw a JOIN lw b USING (word) GROUP BY a.id, b.id"
    " HAVING count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) > 0.4),"
    " ti AS (SELECT li.a AS query_id, li.b AS id, len(list_intersect(x.w, y.w)) AS c, len(x.w) AS na, len(y.w) AS nb, x.text = y.text AS same"
    " FROM li JOIN src x ON x.id = li.a JOIN src y ON y.id = li.b),"
    " sc AS (SELECT query_id, id, same, c::DOUBLE / (na + nb - c) AS jaccard FROM ti WHERE c::DOUBLE / (na + nb - c) > 0.2)"
)


def _sources(t: Tables):
    return t.documents.withColumn("lemma", F.lower("text"))


@query("text_neighbours", f"""WITH {LEMMA} SELECT query_id, "rank", id, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY jaccard DESC, id)::INTEGER AS "rank" FROM sc) WHERE "rank" <= 5""")
def _(t: Tables):
    rows = _sources(t)
    return setjoin.text_neighbours(rows, rows, 5, 0.4, 0.2)


@query("text_neighbours_other_texts", f"""WITH {LEMMA} SELECT query_id, "rank", id, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY jaccard DESC, id)::INTEGER AS "rank" FROM sc WHERE NOT same) WHERE "rank" <= 5""")
def _(t: Tables):
    rows = _sources(t)
    return setjoin.text_neighbours(rows, rows, 5, 0.4, 0.2, remove_identical=True)


@query("text_neighbours_sample", f"""WITH {LEMMA} SELECT query_id, "rank", id, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY {h('query_id', 'id')}, id)::INTEGER AS "rank" FROM sc) WHERE "rank" <= 3""")
def _(t: Tables):
    rows = _sources(t)
    return setjoin.text_neighbours(rows, rows, 3, 0.4, 0.2, mode="sample")


EDGES = (
    f"par AS ({_jaccard_sql(0.4)}), pairs2 AS (SELECT a AS src, b AS dst FROM par UNION ALL SELECT b, a FROM par),"
    " edge AS (SELECT * FROM pairs2 UNION ALL SELECT DISTINCT src, src FROM pairs2)"
)


@query("neighbour_graph", f"WITH {SETS}, {INTER}, {EDGES} SELECT src, dst FROM edge")
def _(t: Tables):
    return setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4))


@query("graph_bfs", f"""WITH RECURSIVE {SETS}, {INTER}, {EDGES}, reach(id, depth) AS (
  SELECT id, 0 FROM (SELECT min(src) AS id FROM edge) UNION SELECT dst, depth + 1 FROM reach JOIN edge ON src = id WHERE depth < 10)
  SELECT id, min(depth)::INTEGER AS depth FROM reach GROUP BY id""")
def _(t: Tables):
    from ..session import materialize

    edges = materialize(setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4)), "edges")
    seeds = edges.agg(F.min("src").alias("id"))
    return setjoin.bfs(edges, seeds, 10)


DOC_PAIRS = (
    " dw AS (SELECT id, unnest(w) AS word, len(w) AS n FROM s0),"
    " dj AS (SELECT a.id AS a, b.id AS b, count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) AS jaccard"
    " FROM dw a JOIN dw b ON a.word = b.word AND a.id < b.id GROUP BY a.id, b.id)"
)


@query("jaccard_join_documents", f"WITH {SETS}, {DOC_PAIRS} SELECT a, b, jaccard FROM dj WHERE jaccard > 0.5")
def _(t: Tables):
    """Every document, those with equal word sets too."""
    return setjoin.jaccard_documents(t.documents, 0.5)


@query("document_families", f"""WITH RECURSIVE {SETS}, {DOC_PAIRS}, e AS (SELECT a, b FROM dj WHERE jaccard > 0.5 UNION ALL SELECT b, a FROM dj WHERE jaccard > 0.5),
  reach(id, other) AS (SELECT id, id FROM s0 UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.other)
  SELECT id, min(other) AS family FROM reach GROUP BY id""")
def _(t: Tables):
    sets, members = setjoin.distinct_sets(t.documents)
    return setjoin.families(setjoin.jaccard_join(t.documents, None, 0.5), members)


@query("neighbour_graph_documents", f"""WITH {SETS}, {DOC_PAIRS}, e AS (SELECT a AS src, b AS dst FROM dj WHERE jaccard > 0.4 UNION ALL SELECT b, a FROM dj WHERE jaccard > 0.4)
  SELECT src, dst FROM e UNION ALL SELECT DISTINCT src, src FROM e""")
def _(t: Tables):
    return setjoin.neighbour_graph(setjoin.jaccard_documents(t.documents, 0.4))


@query("dedup_adjacency_documents", f"""WITH {SETS}, {DOC_PAIRS}, e AS (SELECT a AS src, b AS dst FROM dj WHERE jaccard > 0.4 UNION ALL SELECT b, a FROM dj WHERE jaccard > 0.4)
  SELECT DISTINCT src, text FROM (SELECT src, dst FROM e UNION ALL SELECT src, src FROM e) JOIN documents ON doc_id = dst""")
def _(t: Tables):
    return setjoin.dedup_adjacency(setjoin.neighbour_graph(setjoin.jaccard_documents(t.documents, 0.4)), t.documents)


@query("graph_reach", f"""WITH RECURSIVE {SETS}, {INTER}, {EDGES}, reach(id) AS (
  SELECT id FROM (SELECT min(src) AS id FROM edge) UNION SELECT dst FROM reach JOIN edge ON src = id) SELECT id FROM reach""")
def _(t: Tables):
    """To the end, however many steps it takes."""
    from ..session import materialize

    edges = materialize(setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4)), "edges")
    return setjoin.bfs(edges, edges.agg(F.min("src").alias("id"))).select("id")


@query("edit_pairs", f"""WITH {SETS}, {INTER}, {EDGES}, f AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM edge WHERE src <> dst)
  SELECT src, dst, jaccard FROM (SELECT f.src, f.dst, len(list_intersect(x.w, y.w))::DOUBLE / (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w))) AS jaccard
   FROM f JOIN sets x ON x.id = src JOIN sets y ON y.id = dst WHERE r <= 3) WHERE jaccard > 0.6 AND jaccard < 1.0""")
def _(t: Tables):
    edges = setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4))
    sets = t.documents.select("id", strings.word_set("text").alias("words"))
    return setjoin.edit_pairs(edges, sets, 3, 0.6)


@query("identity_pairs", "SELECT doc_id AS id, text AS base, text AS target FROM documents")
def _(t: Tables):
    return setjoin.identity_pairs(t.documents)


@query("dedup_adjacency", f"WITH {SETS}, {INTER}, {EDGES} SELECT DISTINCT src, text FROM edge JOIN documents ON doc_id = dst")
def _(t: Tables):
    edges = setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4))
    return setjoin.dedup_adjacency(edges, t.documents)


# ------------------------------------------------------------- text vectors

@query("hashed_word_vectors", f"""WITH {TOKENS}, hc AS (SELECT id, ((('0x'||substr(md5(word),1,8))::BIGINT & 2147483647) % 64) AS dim, count(*) AS n FROM tok GROUP BY ALL),
  cells AS (SELECT i.id, d, coalesce(n, 0)::DOUBLE AS x FROM (SELECT DISTINCT id FROM tok) i CROSS JOIN generate_series(0, 63) g(d) LEFT JOIN hc ON hc.id = i.id AND hc.dim = d)
  SELECT id, list(x ORDER BY d) AS vector FROM cells GROUP BY id""")
def _(t: Tables):
    return text.encode_texts(t.documents, "hashed_words")


def _hashed(name, source, key):
    return (
        f"{name}t AS (SELECT {key} AS id, unnest(string_split(text, ' ')) AS word FROM {source}),"
        f" {name}h AS (SELECT id, ((('0x'||substr(md5(word),1,8))::BIGINT & 2147483647) % 64) AS dim, count(*) AS n FROM {name}t GROUP BY ALL),"
        f" {name}v AS (SELECT id, list(x ORDER BY d) AS v FROM (SELECT i.id, d, coalesce(n, 0)::DOUBLE AS x FROM (SELECT DISTINCT id FROM {name}t) i"
        f" CROSS JOIN generate_series(0, 63) g(d) LEFT JOIN {name}h x ON x.id = i.id AND x.dim = d) GROUP BY id),"
        f" {name} AS (SELECT id, list_transform(v, lambda x: x / n) AS v FROM (SELECT id, v, {norm('v')} AS n FROM {name}v))"
    )


@query("semantic_search", f"""WITH {_hashed('q', 'benchmark', 'item_id')}, {_hashed('d', 'documents', 'doc_id')}, r AS ({top(
    f"SELECT a.id AS query_id, b.id AS id, {ip('a.v', 'b.v')} AS distance FROM q a, d b", 4, "distance DESC")})
  SELECT query_id, "rank", id, text, round(distance, 3) AS score FROM r JOIN documents ON doc_id = id""")
def _(t: Tables):
    asked = t("benchmark").select(F.col("item_id").alias("query_id"), "text")
    return text.semantic_search(asked, t.documents, 4)


@query("word_vectors_embedding")
def _(t: Tables):
    """Mean of skip-gram word vectors per conversation turn."""
    rows = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), strings.normalize_question("text").alias("text"))
    vectors = text.word_vectors(rows, dim=16, min_count=2)
    return text.mean_word_embedding(rows, vectors)


@query("vocabulary_word_vectors")
def _(t: Tables):
    rows = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), strings.normalize_question("text").alias("text"))
    return text.lookup_word_vectors(text.vocab_fit(rows), text.word_vectors(rows, dim=16, min_count=2))


@query("hashed_tfidf_vectors")
def _(t: Tables):
    return text.encode_texts(t.documents, "hashed_bag")
