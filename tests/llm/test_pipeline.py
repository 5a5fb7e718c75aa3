from collections import Counter

import corpus_pipeline as P
from lakecraft.llm.tools import documents, stored
from lakecraft.llm.toxicity import fit, score
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_mixing import SEP, want_targets
from tests.llm.test_packing import check_layout, expected, got as pieces_of
from tests.llm.test_substring import SEP as WORDS


def cover(texts, window=35):
    split = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for t, w in zip(texts, split):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone) if gone else t)
    return out


def test_every_stage(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    start = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "minhash near-dedup", "substring dedup", "mixing sources to target weights", "best-fit packing"]
    # toxicity: what the classifier rejects goes, all else stays as it is
    one = stored(P.toxicity(spark, docs, sf), "t1")
    rejected = {r.doc_id for r in score(docs, fit(docs, documents(spark, sf, "labels"))).where("predicted = 1").collect()}
    kept = {r.doc_id: r for r in one.collect()}
    assert one.columns == docs.columns and kept.keys() == start.keys() - rejected and all(kept[d] == start[d] for d in kept)
    toxic = {r.doc_id: r.toxic for r in documents(spark, sf, "labels").collect()}
    known = [toxic[d] for d in rejected if d in toxic]
    assert sum(known) > 0.9 * len(known) > 10
    # near duplicates
    two = stored(P.near_dedup(spark, one, sf), "t2")
    left = {r.doc_id: r for r in two.collect()}
    want = {d for d, _, _, k in near_brute([(d, r.text) for d, r in kept.items()], 5) if k}
    assert two.columns == docs.columns and left.keys() == want and all(left[d] == start[d] for d in left)
    # repeated passages
    three = stored(P.substring_dedup(spark, two, sf), "t3")
    ids = sorted(left)
    texts = dict(zip(ids, cover([left[d].text for d in ids])))
    cut = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and {d: r.text for d, r in cut.items()} == texts
    assert any(texts[d] != left[d].text for d in ids) and all(r.n_chars == len(r.text) for r in cut.values())
    # mixing
    four = stored(P.source_mixing(spark, three, sf), "t4")
    parts = four.collect()
    size, taken, each = Counter(), Counter(), Counter()
    for r in cut.values():
        size[r.source] += len(SEP.findall(r.text))
    for r in parts:
        n = len(SEP.findall(r.text))
        taken[r.source] += n
        each[r.doc_id] += n
        assert r.source == cut[r.doc_id].source and " ".join(SEP.findall(r.text)) in " ".join(SEP.findall(cut[r.doc_id].text))
    target = want_targets(size)
    assert four.columns == docs.columns and all(abs(taken[s] - target[s]) <= 1.5 * 1024 for s in size)
    assert all(n <= 3 * len(SEP.findall(cut[d].text)) for d, n in each.items())
    # packing
    five = P.packing(spark, four, sf).collect()
    assert pieces_of(five) == expected([(r.doc_id, r.text) for r in parts])
    assert check_layout(five) <= -(-sum(r.length for r in five) // 4096) + 1


def test_run_is_registered(spark):
    import __spark_entry__ as e
    assert e.queries()["pipeline"] is P.run
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
