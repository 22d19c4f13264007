import corpus_pipeline
from brute import documents, near_classes, odd_texts
from test_decontaminate import prose as leak_prose
from test_quality import base, prose
from tidelog.llm import packing, scratch
from tidelog.llm.queries import WORD_BPE


def stages(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.keep(stage(spark, out[-1], sf_dir), name))
    return out


def test_each_stage_takes_effect(spark, tmp_path):
    item = " ".join(leak_prose(1, 30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    clean = [(i, prose(i, 100)) for i in range(120)]
    secret = [(300 + i, f'{prose(500 + i, 60)} token = "{"0123456789abcdef"[i:]}{"a9b8c7d6e5f4" * 2}{i:02d}" {prose(700 + i, 40)}') for i in range(12)]
    numbers = [(330 + i, f"{prose(800 + i, 60)} 12345678901234{10 + i} {prose(900 + i, 40)}") for i in range(12)]
    texts = clean + secret + numbers
    texts += [(400 + i, t) for i, t in clean[:10]] + [(420, clean[20][1] + " more"), (430, f"{prose(999, 50)} {item} {prose(998, 50)}"), (440, "short"), (450, "# " * 100)] + odd_texts()
    docs = documents(spark, texts)
    by_stage = [{r["doc_id"] for r in each.collect()} for each in stages(spark, docs, f"file://{tmp_path}")]
    assert by_stage[1] == {i for i, t in texts if base(t)[0] >= 20 and 100 * base(t)[4] <= 30 * base(t)[0] and i != 450}
    assert by_stage[2] == by_stage[1] - {400 + i for i in range(10)} - {420}
    assert by_stage[3] == by_stage[2] - {430} == by_stage[4] == by_stage[5]


def test_columns_and_masks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = stages(spark, docs, sf_dir)
    assert all(each.columns == docs.columns for each in found[:-1])
    kept = {r["doc_id"]: r["text"] for r in found[1].collect()}
    assert len(found[2].collect()) == len(set(near_classes(list(kept.items()))))
    before, after = ({r["doc_id"]: r for r in found[i].collect()} for i in (3, 4))
    assert before.keys() == after.keys()
    assert all(len(r["text"]) == r["n_chars"] for r in after.values())
    again = packing.pack(found[4], WORD_BPE)
    assert found[5].columns == again.columns and found[5].count() == again.count()


def test_run_is_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, two = (sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in f.collect()) for f in (corpus_pipeline.run(spark, sf_dir), stages(spark, docs, sf_dir)[-1]))
    assert one == two


def test_empty_table(spark, sf_dir):
    assert stages(spark, documents(spark, []), sf_dir)[-1].count() == 0
