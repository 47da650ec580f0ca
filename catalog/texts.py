"""Text search over the documents and predicate statistics."""

import uuid

from pyspark.sql import functions as F

from catalog.registry import graph, query, table, table_map
from graphloom.operators import predicates as pr, text as tx
from graphloom.session import shared_folder
from graphloom.sources.mapping import MappedGraph
from graphloom.sources.patternstore import PatternStore
from graphloom.sources.quadstore import QuadStore
from graphloom.sources.textstore import TextStore

_TOKENS = r"""WITH t AS (SELECT doc_id AS record, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{Nd}]+')) AS word
FROM documents), tok AS (SELECT * FROM t WHERE word <> ''),
c AS (SELECT record, word, count(*) AS tf FROM tok GROUP BY ALL) """
_STATS = """, dl AS (SELECT record, count(*) AS dl FROM tok GROUP BY record),
n AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM dl) / (SELECT count(*) FROM documents) AS avdl),
df AS (SELECT word, count(*) AS df FROM c GROUP BY word) """


def _docs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("record"), "text", "source")


def _with_sources(spark, d):
    return _docs(spark, d).withColumn("entity", F.concat(F.lit("<source/"), F.col("source"), F.lit(">")))


def _new_store(spark) -> TextStore:
    return TextStore(spark, f"{shared_folder(spark)}/text-{uuid.uuid4().hex}")


_STORES: dict[tuple[str, str], TextStore] = {}


def _store(spark, d) -> TextStore:
    """The text index of a folder's documents: built on first use in a session, then searched as often as one likes."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES:
        _STORES[key] = _new_store(spark)
        _STORES[key].add(_with_sources(spark, d), entity="entity")
    return _STORES[key]


def _postings(spark, d):
    return _store(spark, d).postings()


@query(_TOKENS + """, kept AS (SELECT c.* FROM c WHERE record NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT c.* FROM c JOIN documents ON record = doc_id WHERE source = 'src1' AND record IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT record, word, tf::DOUBLE AS score, false AS is_entity FROM kept
UNION ALL SELECT DISTINCT record, '<source/' || source || '>', 0.0, true FROM (SELECT DISTINCT record FROM kept) JOIN documents ON record = doc_id""")
def text_index_segments(spark, d):
    """An index built from two segments, one of them delivered twice; toxic records are deleted, some come back, and the segments are merged."""
    store, docs = _new_store(spark), _with_sources(spark, d).where("trim(text) <> ''")
    for part in (0, 1, 0):
        store.add(docs.where(F.col("record") % 2 == part), entity="entity", batch=f"half-{part}")
    toxic = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("record"))
    store.delete(toxic)
    store.merge()
    store.add(docs.join(toxic, "record", "left_semi").where("source = 'src1'"), entity="entity", replace=True)
    return store.postings()


@query(r"""WITH w AS (SELECT DISTINCT p_partkey, p_brand, p_size, unnest(regexp_split_to_array(lower(p_name), '[^\p{L}\p{Nd}]+')) AS word FROM part)
SELECT p_partkey AS text, '<brand/' || p_brand || '>' AS entity, p_size::DOUBLE AS score FROM w WHERE word = 'widget'""")
def text_words_file(spark, d):
    """A words file with own scores as a segment: records that hold a word, with their entities and what the file scores them."""
    part, path = table(spark, d, "part"), f"{shared_folder(spark)}/words-{uuid.uuid4().hex}"
    words = part.select(F.explode(F.array_distinct(tx.tokens("p_name"))).alias("w"), F.lit("0").alias("e"), "p_partkey", F.lit("1.0").alias("s"))
    brands = part.select(F.concat(F.lit("<brand/"), F.col("p_brand"), F.lit(">")).alias("w"), F.lit("1").alias("e"), "p_partkey", F.col("p_size").cast("string").alias("s"))
    words.unionByName(brands).select(F.concat_ws("\t", "w", "e", "p_partkey", "s").alias("value")).write.text(path)
    store = _new_store(spark)
    store.add_words(tx.read_words(spark, path))
    return tx.entity_search(store.postings(), "Widget", score="score")


@query(_TOKENS + _STATS + """SELECT w AS word, false AS is_entity, doc_id * 3 - 1 AS record, round(coalesce(c.tf * 2.75 / (1.75 * (0.25 + 0.75 * dl.dl / avdl) + c.tf)
* log2(n.n / df.df), 0), 5) AS score FROM documents CROSS JOIN (SELECT unnest(['the', 'der', 'les']) AS w) t
LEFT JOIN c ON c.record = doc_id AND c.word = w LEFT JOIN df ON df.word = w LEFT JOIN dl ON dl.record = doc_id, n""")
def text_score_postings(spark, d):
    """Scores for given postings: each record takes the text of the next document at or after it."""
    docs = _docs(spark, d).withColumn("record", F.col("record") * 3)
    given = docs.select((F.col("record") - 1).alias("record"), F.explode(F.array(*[F.lit(w) for w in ("the", "der", "les")])).alias("word"))
    postings = given.select("word", F.lit(False).alias("is_entity"), "record", F.lit(1.0).alias("score"))
    scored = tx.score_postings(postings, docs, tx.Scoring("bm25"))
    return scored.withColumn("score", F.round("score", 5))


@query(_TOKENS + "SELECT record, word, tf FROM c")
def text_postings(spark, d):
    return tx.term_counts(_docs(spark, d))


@query(r"""WITH lits AS (SELECT DISTINCT n_name AS lex FROM nation UNION SELECT DISTINCT r_name FROM region
UNION SELECT DISTINCT p_name FROM part), w AS (SELECT DISTINCT lex, unnest(regexp_split_to_array(lower(lex), '[^\p{L}\p{Nd}]+')) AS word FROM lits)
SELECT '"' || lex || '"' AS s, '<urn:text:has-word>' AS p, '"' || word || '"' AS o FROM w WHERE word <> ''""")
def text_has_word(spark, d):
    return tx.has_word_quads(graph(spark, d, "nation", "region", "part"), ["<nation/name>", "<region/name>", "<part/name>"])


@query(r"""WITH lits AS (SELECT DISTINCT p_name AS lex FROM part), w AS (SELECT lex,
unnest(regexp_split_to_array(lower(lex), '[^\p{L}\p{Nd}]+')) AS word FROM lits)
SELECT '"' || lex || '"' AS entity FROM w WHERE word = 'widget' GROUP BY ALL""")
def text_literal_entities(spark, d):
    records = tx.literal_records(graph(spark, d, "part"), ["<part/name>"])
    return tx.entity_search(tx.build_postings(records, entity="entity"), "widget").select("entity")


@query(_TOKENS + "SELECT record AS text, tf::DOUBLE AS score FROM c WHERE word = 'leaux'")
def text_word_search(spark, d):
    return tx.word_search(_postings(spark, d), "Leaux", score="score")


@query(_TOKENS + "SELECT record AS text, word AS match_text_ver, tf::DOUBLE AS score FROM c WHERE starts_with(word, 'ver')")
def text_prefix_search(spark, d):
    return tx.word_search(_postings(spark, d), "ver*", score="score")


@query(_TOKENS + """SELECT c.record AS text, '<source/' || source || '>' AS entity FROM c
JOIN documents ON record = doc_id WHERE word = 'the'""")
def text_entity_search(spark, d):
    return tx.entity_search(_postings(spark, d), "the")


@query(_TOKENS + """SELECT c.record AS text FROM c JOIN documents ON record = doc_id
WHERE word = 'the' AND source = 'src7'""")
def text_entity_fixed(spark, d):
    return tx.entity_search(_postings(spark, d), "the", fixed="<source/src7>")


@query(_TOKENS + """SELECT a.record AS text, a.tf::DOUBLE AS score_0, b.word AS match_text_th, b.tf::DOUBLE AS score_1
FROM c a JOIN c b USING (record) WHERE a.word = 'and' AND starts_with(b.word, 'th')""")
def text_multi_word_search(spark, d):
    return tx.multi_word_search(_postings(spark, d), "and th*", scores=True)


@query(_TOKENS + """SELECT a.record AS t, a.tf::DOUBLE AS sa, '<source/' || source || '>' AS e
FROM c a JOIN c b USING (record) JOIN documents ON a.record = doc_id WHERE a.word = 'and' AND b.word = 'with'""")
def text_search_clauses(spark, d):
    configs = [tx.SearchConfig("t", entity="?e"), tx.SearchConfig("t", word="and", score="sa"),
               tx.SearchConfig("t", word="with")]
    return tx.text_search(_postings(spark, d), configs)


@query(_TOKENS + _STATS + """SELECT record, word, tf, round(tf * log2(n.n / df.df), 5) AS score
FROM c JOIN df USING (word), n""")
def text_score_tfidf(spark, d):
    scored = tx.scored_postings(_docs(spark, d), tx.Scoring("tfidf"))
    return scored.withColumn("score", F.round("score", 5))


@query(_TOKENS + _STATS + """SELECT record, word, tf, round(tf * 2.75 / (1.75 * (0.25 + 0.75 * dl.dl / avdl) + tf)
* log2(n.n / df.df), 5) AS score FROM c JOIN df USING (word) JOIN dl USING (record), n
WHERE word IN ('the', 'der', 'les', 'leaux')""")
def text_score_bm25(spark, d):
    scored = _store(spark, d).scored(tx.Scoring("bm25"), ["the", "der", "les", "leaux"])
    return scored.withColumn("score", F.round("score", 5))


@query("""SELECT o_orderkey AS record, min(doc_id * 3) AS doc FROM orders JOIN documents ON doc_id * 3 >= o_orderkey GROUP BY o_orderkey""")
def text_next_document(spark, d):
    docs = table(spark, d, "documents").select((F.col("doc_id") * 3).alias("record"))
    return tx.next_at_or_after(table(spark, d, "orders").select(F.col("o_orderkey").alias("record")), docs)


@query("""SELECT record, text FROM (SELECT l.doc_id * 2 AS record, min(d.doc_id) AS doc FROM labels l
JOIN documents d ON d.doc_id * 3 >= l.doc_id * 2 GROUP BY 1) JOIN documents ON doc_id = doc""")
def text_of_records(spark, d):
    docs = _docs(spark, d).withColumn("record", F.col("record") * 3)
    return tx.text_of_record(table(spark, d, "labels").select((F.col("doc_id") * 2).alias("record")), docs)


@query(_TOKENS + """, hits AS (SELECT '<source/' || source || '>' AS entity, c.record AS text, word AS match_text_th, tf::DOUBLE AS score
FROM c JOIN documents ON record = doc_id WHERE starts_with(word, 'th')),
best AS (SELECT entity, text, row_number() OVER (PARTITION BY entity ORDER BY max(score) DESC, text DESC) AS r
FROM hits GROUP BY entity, text)
SELECT hits.* FROM hits JOIN best USING (entity, text) WHERE r <= 3""")
def text_limit(spark, d):
    p = _postings(spark, d)
    hits = tx.entity_search(p, "th*", score=None).select("entity", "text", "match_text_th")
    scored = hits.join(tx.word_search(p, "th*", score="score"), ["text", "match_text_th"])
    return tx.text_limit(scored.select("entity", "text", "match_text_th", "score"), 3, ["entity"], "text", ["score"])


_PRED = """WITH sp AS (SELECT '<documents/' || doc_id || '>' AS s, unnest(['<documents/doc_id>', '<documents/text>',
'<documents/lang>', '<documents/source>', '<documents/n_chars>', '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>']) AS p
FROM documents UNION SELECT '<documents/' || doc_id || '>', unnest(['<labels/doc_id>', '<labels/quality>', '<labels/toxic>',
'<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>']) FROM labels) """


def _described(spark, d):
    """Documents and, on the same subjects, their labels where there are some."""
    docs = graph(spark, d, "documents").quads()
    labels = MappedGraph([table_map(spark, d, "labels")]).quads()
    return docs.unionByName(labels.withColumn("s", F.replace("s", F.lit("<labels/"), F.lit("<documents/"))))


@query(_PRED + "SELECT s, p FROM sp")
def has_predicate_full(spark, d):
    return pr.has_predicate(_described(spark, d))


@query(_PRED + "SELECT s, p FROM sp WHERE p = '<labels/quality>'")
def has_predicate_fixed(spark, d):
    return pr.has_predicate(_described(spark, d), predicate="<labels/quality>")


@query(_PRED + """SELECT p, count(DISTINCT s) AS n FROM sp WHERE s IN (SELECT '<documents/' || doc_id || '>' FROM documents
WHERE lang = 'en') GROUP BY p""")
def available_predicates(spark, d):
    english = table(spark, d, "documents").where("lang = 'en'").select(
        F.concat(F.lit("<documents/"), F.col("doc_id"), F.lit(">")).alias("s"))
    return pr.available_predicates(_described(spark, d), english)


_STATES: dict[tuple[str, str], tuple] = {}


def _described_store(spark, d):
    """The described documents as a store, and their pattern dictionary: built on first use in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STATES:
        base = f"{shared_folder(spark)}/described-{uuid.uuid4().hex}"
        store, patterns = QuadStore(spark, f"{base}/quads").create(_described(spark, d), ("p", "s")), PatternStore(spark, f"{base}/patterns")
        patterns.refresh(store)
        # An update after the first build: the dictionary takes in the changed subjects only.
        quality = graph(spark, d, "labels").quads(["<labels/quality>"])
        low = quality.where(F.col("o_term.i") == 0).withColumn("s", F.replace("s", F.lit("<labels/"), F.lit("<documents/")))
        new = low.select("s", F.lit("<reviewed>").alias("p"), F.lit('"yes"').alias("o"), "g")
        store.update(inserts=new, deletes=low)
        patterns.refresh(store)
        _STATES[key] = store, patterns
    return _STATES[key]


@query(_PRED + """, low AS (SELECT '<documents/' || doc_id || '>' AS s FROM labels WHERE quality = 0),
now AS (SELECT * FROM sp WHERE NOT (p = '<labels/quality>' AND s IN (SELECT s FROM low)) UNION SELECT s, '<reviewed>' FROM low),
english AS (SELECT '<documents/' || doc_id || '>' AS s FROM documents WHERE lang = 'en')
SELECT 'all' AS what, p, count(*) AS n FROM now GROUP BY p
UNION ALL SELECT 'en', p, count(*) FROM now WHERE s IN (SELECT s FROM english) GROUP BY p""")
def available_predicates_stored(spark, d):
    """Autocompletion from the stored pattern dictionary, right after an update: for all subjects and for some."""
    patterns = _described_store(spark, d)[1]
    english = table(spark, d, "documents").where("lang = 'en'").select(F.concat(F.lit("<documents/"), F.col("doc_id"), F.lit(">")).alias("s"))
    whole, some = patterns.available_predicates(), patterns.available_predicates(english)
    return whole.select(F.lit("all").alias("what"), "p", "n").unionByName(some.select(F.lit("en").alias("what"), "p", "n"))


@query(_PRED + "SELECT p, count(DISTINCT s) AS n FROM sp GROUP BY p")
def available_predicates_from_patterns(spark, d):
    return pr.available_from_patterns(pr.subject_patterns(_described(spark, d)))


@query(_PRED + """SELECT md5(pat) AS pattern_id, count(*) AS n_subjects FROM
(SELECT s, string_agg(p, chr(10) ORDER BY p) AS pat FROM sp GROUP BY s) GROUP BY pat""")
def predicate_patterns(spark, d):
    return pr.pattern_table(pr.subject_patterns(_described(spark, d))).select("pattern_id", "n_subjects")


@query(_PRED + """SELECT count(*) AS n_pairs, count(*) / count(DISTINCT s) AS predicates_per_subject,
count(*) / count(DISTINCT p) AS subjects_per_predicate FROM sp""")
def predicate_pattern_statistics(spark, d):
    return pr.pattern_statistics(_described(spark, d))


@query("""SELECT 7 * count(*) AS n_triples, count(*) AS n_subjects, 7 AS n_predicates,
count(*) + count(DISTINCT o_custkey) + count(DISTINCT o_orderstatus) + count(DISTINCT o_totalprice)
  + count(DISTINCT o_orderdate) + count(DISTINCT o_orderpriority) + 1 AS n_objects, 0 AS n_graphs,
count(*) AS n_typed_subjects, 5 * count(*) AS n_literal_objects, 2 * count(*) AS n_iri_objects,
0 AS n_blank_objects, 0 AS n_blank_subjects FROM orders""")
def dataset_statistics(spark, d):
    return pr.dataset_statistics(graph(spark, d, "orders"))


@query("""SELECT p, n FROM (
SELECT '<orders/' || unnest(['orderkey', 'custkey', 'orderstatus', 'totalprice', 'orderdate', 'orderpriority']) || '>' AS p,
  (SELECT count(*) FROM orders) AS n
UNION ALL SELECT '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
UNION ALL SELECT '<customer/' || unnest(['custkey', 'name', 'nationkey', 'acctbal', 'mktsegment']) || '>',
  (SELECT count(*) FROM customer)) ORDER BY n DESC, p LIMIT 10""")
def top_predicates(spark, d):
    return pr.top_predicates(graph(spark, d, "orders", "customer"))
