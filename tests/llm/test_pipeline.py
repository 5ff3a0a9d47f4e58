"""The pipeline's stages beside plain versions of what they decide."""

import corpus_pipeline
from test_operators import cut_plainly

PATH = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    rows = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows[-1], PATH)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS
            out = out.cache()
        rows.append(out)
    named, single, cut, mixed, encoded = rows[1:]
    assert 0.95 * docs.count() <= named.count() <= docs.count()

    def sets(frame):
        out = {}
        for r in frame.select("doc_id", "text").collect():
            w = b" ".join(r["text"].encode().split()).lower().split()
            out[r["doc_id"]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
        return out

    before, kept = sets(named), sets(single)
    near = [(a, b) for a in before for b in before if a < b and 100 * len(before[a] & before[b]) >= 80 * len(before[a] | before[b])]
    root = {i: i for i in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert set(kept) == {find(i) for i in before}
    old = {r["doc_id"]: r["text"] for r in single.select("doc_id", "text").collect()}
    new = {r["doc_id"]: r["text"] for r in cut.select("doc_id", "text").collect()}
    for (i, text), (_, gone, plain) in zip(old.items(), cut_plainly(old.values())):
        assert new[i] == (plain.decode() if gone else text)
    assert set(r["doc_id"] for r in mixed.select("doc_id").collect()) <= set(new)
    assert encoded.count() == mixed.count() == corpus_pipeline.run(spark, PATH).count()
