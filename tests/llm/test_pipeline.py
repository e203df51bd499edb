import os
import sys

import public_tokenizers

from scorewatch.llm.packing import ByteBpe

from .helpers import SF, empty, messy, messy_rows
from .test_jaccard import plain_components, plain_set
from .test_packing import check

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def stages():
    import corpus_pipeline as p
    return p


def test_stages_in_order():
    assert [n for n, _ in stages().STAGES] == ["toxicity", "quality_rules", "near_duplicates", "packing"]


def test_each_stage_on_its_own_input(spark, tmp_path):
    """Every decision of a stage agrees with its operator's own result on the same input."""
    from scorewatch.llm.quality import quality_verdicts
    from scorewatch.llm.toxicity import toxicity_score, train, training_labels
    p = stages()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bpe = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    for i, (name, step) in enumerate(p.STAGES):
        out = step(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        before = {r.doc_id: r.text for r in docs.collect()}
        if name != "packing":
            assert kept.columns == docs.columns
            after = {r.doc_id: tuple(r) for r in kept.collect()}
            assert all(after[r.doc_id] == tuple(r) for r in docs.collect() if r.doc_id in after)
        if name == "toxicity":
            model = train(docs, training_labels(labels))
            want = {r.doc_id for r in docs.select("doc_id", toxicity_score(spark, model).alias("s")).collect() if r.s < 0.5}
            toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
            assert not toxic & set(after) or len(toxic & set(after)) <= 0.4 * len(toxic)
        elif name == "quality_rules":
            want = {r.doc_id for r in quality_verdicts(docs).collect() if r.kept}
        elif name == "near_duplicates":
            want = {int(d) for d, _, c in plain_components(list(before.items()), 5, 80, 100) if d == c}
        else:
            check(kept.collect(), list(before.items()), bpe)
            break
        assert set(after) == want
        docs = kept


def test_run_equals_the_stages(spark, tmp_path):
    p = stages()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, step in p.STAGES:
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    pick = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, p.run(spark, SF).select(*pick).collect())) == sorted(map(tuple, docs.select(*pick).collect()))


def test_messy_and_empty_tables(spark, tmp_path):
    for make, name in ((messy, "messy"), (empty, "empty")):
        docs = make(spark)
        for stage_name, step in stages().STAGES:
            out = step(spark, docs, SF)
            if stage_name != "packing":
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}-{stage_name}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}-{stage_name}"))
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {r[0] for r in messy_rows()} and (name == "messy") == bool(ids)
    assert plain_set("a b c d e", 5) == {("a", "b", "c", "d", "e")}
