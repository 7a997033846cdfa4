"""The grammar clause by clause, and its scores on held-out documents."""

import pyarrow as pa
import pytest

from tarmac.llm import pattern_grammar as pg
from tarmac.llm.tables import table


@pytest.mark.parametrize(
    ("words", "less"),
    [
        ("you are an idiot", "what an idiot"),
        ("idiot", "not an idiot"),
        ("you idiot", "she said you idiot"),
        ("idiot and moron", "idiot"),
        ("i will kill you", "it will kill time"),
        ("i will kill you", "i will never kill you"),
        ("idiot", "stupid"),
        ("idiot", "nothing of the kind"),
    ],
)
def test_order_of_clauses(words, less):
    lexicon = pg.Lexicon()
    for symbol, seeds in pg.SEEDS.items():
        lexicon.words.update(dict.fromkeys(seeds.split(), symbol))
    grammar = pg.toxicity_grammar()

    def weight(text):
        return grammar.clause([lexicon.symbol(word) for word in text.split()])

    assert weight(words) > weight(less)


def test_composition_adds_weights():
    first, second = pg.insult_machine(), pg.report_machine()
    both, alone = pg.compiled(pg.composed(first, second)), [pg.compiled(m) for m in (first, second)]
    for clause in ([1], [6, 1], [1, 6, 2], [0, 3, 6, 3], []):
        assert both.clause(clause) == sum(machine.clause(clause) for machine in alone)


def test_words_are_read_through_marks_and_digits():
    assert pg.core_of("(Idiot!!") == "idiot" and pg.core_of("1d10t") == "idiot" and pg.core_of("***") == ""
    lexicon = pg.Lexicon({"idiot": pg.INSULT}, {"trott": pg.INSULT})
    assert [lexicon.symbol(w) for w in ("IDIOT.", "Trottels,", "trott", "idiotic")] == [1, 1, 0, 0]


def test_features_count_clauses():
    lexicon = pg.Lexicon({"idiot": pg.INSULT, "not": pg.NEGATION})
    found = pg.features(pa.array(["an idiot. fine\nidiot here", None, "", "all fine", "x. " * 50_000 + "idiot"]), lexicon, pg.toxicity_grammar())
    assert found[:, 0].round(6).tolist() == [1.098612, 0, 0, 0, 0.693147]
    assert found[0, 3] == pytest.approx(2 / 3) and not found[1:4].any()


def test_scores_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = pg.learn(docs, labels)
    scored = pg.score(docs, model)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    clean = [r.predicted for r in held if r.toxic == 0]
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    toxic = [r.predicted for r in held if r.toxic == 1 and r.doc_id in english]
    assert sum(clean) <= 0.02 * len(clean) and toxic and sum(toxic) >= 0.9 * len(toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_every_language_is_caught_with_enough_labels(spark):
    """With the labels of ten thousand documents; of a few hundred, languages other than English are caught in part."""
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = pg.score(docs, pg.learn(docs, labels)).where("held_out")
    rows = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.02 * sum(r.toxic == 0 for r in rows)
    for lang in ("de", "en", "es", "fr"):
        toxic = [r.predicted for r in rows if r.toxic == 1 and r.lang == lang]
        assert toxic and sum(toxic) >= 0.85 * len(toxic), lang


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 1), (None, 1, 1), (6, 0, 7)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("doc_id > 9")):
        model = pg.learn(edge_docs, known)
        scored = pg.score(edge_docs, model).collect()
        assert len(scored) == edge_docs.count() and not any(r.predicted for r in scored)
        assert pg.score(no_docs, model).count() == 0
