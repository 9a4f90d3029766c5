"""Pipeline stages on ids at the edge of 64 bits, repeated and missing."""

import corpus_pipeline as P

KIND = "doc_id long, text string, lang string, source string, n_chars long, num int, at string, late boolean"
BASE = " ".join(f"word{i}" for i in range(60))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "x", True) for i, t in rows], KIND)
    out = P.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_ids_at_the_edge(spark):
    near, far = BASE + " end", " ".join(f"other{i}" for i in range(60))
    for top in (2**63 - 1, 2**63 - 2):
        # of near copies the smallest id stays; repeated and missing ids come after all others
        got = kept(spark, [(top, BASE), (None, near), (5, far), (5, far + " x")])
        assert (top, BASE) in got and len(got) == 2 and all(i in (5, top) for i, _ in got)
        assert kept(spark, [(None, near), (top, BASE)]) == [(top, BASE)]
        assert kept(spark, [(-(2**63), near), (top, BASE), (top, BASE + " again")]) == [(-(2**63), near)]
    assert kept(spark, [(None, BASE), (None, near)]) in ([(None, BASE)], [(None, near)])
