
import os

import pyarrow as pa

import corpus_pipeline as cp
from tessera.llm import secrets, toxicity
from tessera.llm.registry import read
from tessera.session import shared_dir

from .conftest import SF, rows
from .test_decontam import brute as contaminated
from .test_mixing import brute as mixed
from .test_ngram_join import brute as classes
from .test_secrets import base as secret_spans


def masked(text):
    out, at = [], 0
    for s, _, e, _ in secret_spans(text):
        if s >= at:
            out += [text[at:s], secrets.MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def brute(spark):
    """The stages in plain Python (the toxicity machine is the trained one)."""
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in rows("documents")}
    machine = toxicity.fit(read(spark, SF, "documents"), read(spark, SF, "labels"))
    score = machine.scores(pa.array([t for t, _ in docs.values()]))
    docs = {d: v for (d, v), s in zip(docs.items(), score) if s < 0.7}
    docs = {d: docs[d] for d, c, _ in classes([(d, t) for d, (t, _) in docs.items()]) if d == c}
    bad = contaminated([(d, t) for d, (t, _) in docs.items()], [(r["item_id"], r["text"]) for r in rows("benchmark")])
    docs = {d: (masked(t), s) for d, (t, s) in docs.items() if not bad[d][4]}
    return mixed([(d, t, s) for d, (t, s) in docs.items()])


def test_run_equals_brute_force(spark):
    got = sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in cp.run(spark, SF).collect())
    want = brute(spark)
    assert got == want and 100 < len(want) < len(rows("documents"))


def test_nothing_but_the_result_is_left(spark):
    """The shared folder holds one more table after a run: the last stage's."""
    def held():
        path = shared_dir(spark).removeprefix("file://")
        return set(os.listdir(path))

    before = held()
    out = cp.run(spark, SF.replace("sf0.01", "sf0.001"))
    assert [n.rsplit("-", 1)[0] for n in held() - before] == ["stage-mix"] and out.count() > 0


def test_stage_order_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_join", "decontaminate", "secrets", "mix"]
    docs = read(spark, SF, "documents")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert sorted(docs.columns) == sorted(read(spark, SF, "documents").columns)


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty and repeated rows, an empty table, and columns that clash with inner names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a few words of text here", None, "s", 24), (3, "same text " * 20, "en", "s", 200),
           (3, "same text " * 20, "en", "s", 200), (4, "same text " * 20, "en", "t", 200), (5, "password=abcdefgh12", "en", None, 19),
           (None, None, None, None, None), (6, "w " * 50000, "en", "s", 100000)]
    df = spark.createDataFrame(odd, schema)
    clash = df.selectExpr("*", "1 as d", "'k' as key", "2 as found", "3 as doc", "'x' as _strong", "4 as secret_spans", "5 as label", "6 as n_hit")
    counts = []
    for docs in (df, clash):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            if name != "mix":
                assert out.columns == docs.columns
            counts.append(out.count())
            docs = out
    assert counts[:5] == counts[5:] and counts[1] == 6 + 1
    row = [r for r in cp.mask_secrets(spark, df, SF).collect() if r.doc_id == 5][0]
    assert (row.text, row.n_chars) == (secrets.MASK, len(secrets.MASK))
    for _, stage in cp.STAGES:
        assert stage(spark, df.limit(0), SF).count() == 0


