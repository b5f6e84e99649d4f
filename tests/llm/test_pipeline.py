"""The pipeline's stages on the smallest tables, each against its own input."""

import corpus_pipeline
from devpulse.llm import queries, simhash
from devpulse.plans.staging import stage_table

SF001 = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "simhash_near_duplicates", "packing"]
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage_table(stage(spark, seen[-1], SF001), f"t-{name}"))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == columns for d in seen[:-1])
    assert ids[0] > ids[1] >= ids[2] >= ids[3] == ids[4]  # packing loses no document
    bad = {i for i, r in labels.items() if r.quality == 0}
    assert len(bad & ids[1]) <= 0.2 * len(bad) and len(ids[1]) >= 0.8 * (len(ids[0]) - len(bad))
    texts = {r.doc_id: r.text for r in seen[2].select("doc_id", "text").collect()}
    fps = {i: simhash.fingerprint(t, queries.SHINGLE_WORDS) for i, t in texts.items()}
    group = {i: i for i in fps}
    for i in sorted(fps):
        for j in sorted(fps):
            if j < i and bin(fps[i] ^ fps[j]).count("1") <= queries.MAX_BITS and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert ids[3] == set(group.values())
