import importlib.util
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import mixing as M

from .conftest import DOC_SCHEMA, some_words

WEIGHTS = {"good": 0.9, "low": 0.1, "toxic": 0.0}


def corpus(n=900):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        w = some_words(rng, rng.randint(30, 120), 800)
        kind = rng.choice(["good", "good", "good", "low", "toxic"])
        if kind == "toxic":
            for x in rng.sample(["idiot", "scum", "moron"], 2):
                w.insert(rng.randrange(len(w)), x)
        if kind == "low":
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", "s", 0))
        if i % 2 == 0:
            labels.append((i, 0 if kind == "low" else 1, 1 if kind == "toxic" else 0))
        rows[-1] += (kind,)
    return rows, labels


@pytest.fixture(scope="module")
def mixed(llm):
    rows, labels = corpus()
    df, lab = llm.createDataFrame([r[:5] for r in rows], DOC_SCHEMA).repartition(5), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, M.mix(df, lab, WEIGHTS).toPandas().sort_values("doc_id"), M.mix(df, lab, WEIGHTS, most_rate=1.0).toPandas().sort_values("doc_id")


def test_held_out_accuracy(mixed):
    rows, got, _ = mixed
    odd = [i for i in range(len(rows)) if i % 2]  # never labelled
    assert np.mean([got.domain.iloc[i] == rows[i][5] for i in odd]) > 0.95


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_solve_the_least_squares(mixed, most):
    """Against plain projected gradient in memory, run much longer."""
    _, free, bound = mixed
    got = free if most is None else bound
    p, n = got[[f"p_{d}" for d in M.DOMAINS]].to_numpy(), got.n_tokens.to_numpy(float)
    present = n @ p
    wanted = np.array([WEIGHTS[d] for d in M.DOMAINS]) * present[0] / WEIGHTS["good"]
    rate = np.ones(len(p))
    for _ in range(3000):
        rate = np.clip(rate - p @ (((n * rate) @ p - wanted) / present), 0, most)
    loss = lambda r: ((((n * r) @ p - wanted) ** 2) / present).sum()
    start = loss(np.ones(len(p)))
    assert (got.rate >= 0).all() and loss(got.rate.to_numpy()) <= loss(rate) + 1e-3 * start
    if most is None:
        reached = (n * got.rate.to_numpy()) @ p
        assert np.abs(reached - wanted).max() < 0.02 * present.sum()
    else:
        assert (got.rate <= 1).all()


@pytest.mark.parametrize("low", [0.05, 0.15])
def test_resampled_tokens_meet_the_targets(llm, low):
    """Of a domain whose documents have nearly equal rates a part stays."""
    rows, labels = corpus(2000)
    df, lab = llm.createDataFrame([r[:5] for r in rows], DOC_SCHEMA).repartition(5), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in M.resample(df, lab, {"good": 1 - low, "low": low, "toxic": 0.0}, most_rate=1.0).select("doc_id").collect()}
    tokens = {k: sum(len(r[1].split()) for r in rows if r[5] == k and r[0] in kept) for k in M.DOMAINS}
    assert tokens["toxic"] == 0
    assert tokens["good"] > 0.97 * sum(len(r[1].split()) for r in rows if r[5] == "good")
    assert abs(tokens["low"] / sum(tokens.values()) - low) < 0.3 * low


def test_a_rate_under_one_half_meets_its_target(llm):
    """The good texts' rate is far under 1/2; a part of them stays, not none."""
    rows, labels = corpus(2500)
    df, lab = llm.createDataFrame([r[:5] for r in rows], DOC_SCHEMA).repartition(5), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    tokens = lambda kind, kept=None: sum(len(r[1].split()) for r in rows if r[5] == kind and (kept is None or r[0] in kept))
    share = tokens("low") / (tokens("low") + 0.3 * tokens("good"))
    weights = {"good": 1 - share, "low": share, "toxic": 0.0}
    model = M.fit_classifier(*M.labelled_rows(df, lab))
    history, report = M.fit_rates(M.with_posteriors(df.select("doc_id", "text"), model), weights, 1.0, budget_domain="low")
    assert report["converged"] and report["rounds"] == len(history)
    got = M.with_posteriors(df.select("doc_id", "text"), model, keep_text=True).withColumn("copies", M.copies_column(M.rate_column(history, 1.0), M.draw_column(F.col("doc_id"), F.col("text"))))
    kept = {r.doc_id for r in got.where("copies > 0").collect()}
    assert tokens("toxic", kept) < 0.02 * tokens("toxic")
    assert abs(tokens("good", kept) / tokens("good") - 0.3) < 0.06
    assert tokens("low", kept) > 0.95 * tokens("low")


def test_odd_rows(llm, odd_docs, clash, no_docs):
    labels = llm.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, 0), (None, 1, 1), (10, 1, 0), (6, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = M.mix(clash, labels, WEIGHTS).collect()
    assert len(got) == odd_docs.count() and all(abs(r.p_good + r.p_low + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r.doc_id for r in odd_docs.collect()), key=repr)
    assert M.mix(no_docs, labels, WEIGHTS).collect() == []
    even = M.mix(odd_docs, labels.limit(0), WEIGHTS).collect()
    assert {round(r.p_good, 9) for r in even} == {round(1 / 3, 9)}
    same = M.resample(clash, labels, WEIGHTS, most_rate=1.0)
    assert same.columns == clash.columns and same.count() <= odd_docs.count()


def test_pipeline(llm, tmp_path):
    """Each stage against what its operator says of its own input."""
    if importlib.util.find_spec("corpus_pipeline") is None:
        pytest.skip("no pipeline here")
    import corpus_pipeline as P

    rows, labels = corpus(400)
    rng = random.Random(10)
    docs = [r[:5] for r in rows]
    docs += [(1000 + i, docs[i][1] + " tail", "en", "s", 0) for i in range(0, 40, 2)]
    passage = " ".join(some_words(rng, 60, 5000))
    docs += [(2000 + i, " ".join(some_words(rng, 80, 5000)) + " " + passage, "en", "s", 0) for i in range(10)]
    docs += [(3000, None, None, None, None), (3001, "", "en", "s", 0), (None, passage * 2, "en", "s", 0)]
    llm.createDataFrame(docs, DOC_SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    from fleetlens.llm import mixing, packing, quality, shingle_join, substrings
    from fleetlens.llm.queries import DOMAIN_WEIGHTS

    now = llm.read.parquet(f"{tmp_path}/documents.parquet")
    assert 4 <= len(P.STAGES) <= 5
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(llm, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        out = llm.read.parquet(f"{tmp_path}/{k}")
        if name == "quality rules":
            assert ids(out) == ids(quality.quality_rules(now).where("kept"))
        elif name == "n-gram Jaccard join":
            assert ids(out) == ids(shingle_join.shingle_join(now).where("doc_id is null or doc_id = component_id"))
            assert not {1000 + i for i in range(0, 40, 2)} & set(ids(out))
        elif name == "substring dedup":
            left = {r.doc_id: r for r in substrings.remove_repeats(now).collect()}
            assert sum(r.n_removed > 0 for r in left.values()) >= 9
            for r in out.collect():
                assert len(r.text.split()) == left[r.doc_id].n_words - left[r.doc_id].n_removed and r.n_chars == len(r.text)
        elif name.startswith("mixing"):
            rate = mixing.mix(now, llm.read.parquet(f"{tmp_path}/labels.parquet"), DOMAIN_WEIGHTS, most_rate=1.0)
            # Worked out here from the rates: a rate's fraction is the chance.
            texts = [(r.doc_id, r.text) for r in now.collect()]
            rows = llm.createDataFrame(texts, "doc_id long, text string").withColumn("u", mixing.draw_column(F.col("doc_id"), F.col("text")))
            want, drawn = {r.doc_id: r.rate for r in rate.collect()}, {r.doc_id: r.u for r in rows.collect()}
            assert len(want) == len(texts)
            assert ids(out) == sorted((i for i in want if want[i] + drawn[i] >= 1), key=repr)
            assert sum(want[i] == 1 for i in want) > 100 and any(0.05 < want[i] < 0.95 for i in want)
            assert not [r.text for r in out.collect() if "scum" in r.text.split()]
            assert out.count() > 150
        else:
            assert sorted({r.doc_id for r in out.collect()}, key=repr) == sorted(set(ids(now)), key=repr)
        if k < len(P.STAGES) - 1:
            assert out.columns == now.columns
        now = out
    assert P.run(llm, str(tmp_path)).count() == now.count()


def test_stages_take_any_columns_and_empty_tables(llm, clash, no_docs, tmp_path):
    if importlib.util.find_spec("corpus_pipeline") is None:
        pytest.skip("no pipeline here")
    import corpus_pipeline as P

    llm.createDataFrame([(6, 1, 0), (None, 1, 1), (10, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(llm, clash, str(tmp_path))
        none = stage(llm, no_docs, str(tmp_path))
        assert none.collect() == [], name
        if k < len(P.STAGES) - 1:
            assert out.columns == clash.columns and none.columns == no_docs.columns, name
            rows = out.collect()
            assert len(rows) <= clash.count() and all(r[c] == "clash" for r in rows for c in ("page url", "a.b", 'quoted "`name', "row", "n_removed")), name
        else:
            assert out.count() >= clash.count()


def test_large_ids_beside_a_null(llm):
    """Ids above 2**53 are looked up as they are, also where an id is null."""
    from fleetlens.llm import shingle_join, substrings

    rng = random.Random(3)
    passage = " ".join(some_words(rng, 80, 5000))
    big = (1 << 53) + 1
    rows = [(big, passage), (big + 2, passage), (None, passage), (big + 4, passage + " " + " ".join(some_words(rng, 90, 5000)))]
    df = llm.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_id for r in shingle_join.one_of_each(df).collect()), key=repr) == sorted([big, None, big + 4], key=repr)
    left = {r.doc_id: len(r.text.split()) for r in substrings.without_repeats(df).collect()}
    assert left == {big: 80, big + 2: 0, None: 80, big + 4: 90}
