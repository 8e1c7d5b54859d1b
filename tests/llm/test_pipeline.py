"""The stages of the pipeline on a small corpus with planted cases."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codeweft.llm.secrets import MASK


@pytest.fixture(scope="module")
def run(llm, tmp_path_factory):
    folder = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    base = docs.where("length(text) > 600 AND lang = 'en'").orderBy("doc_id").limit(1).selectExpr("lang", "source", "text").first()
    clean = " ".join(f"clean{k} words of the text{k % 7} stay as they are" for k in range(60))
    planted = [
        (900_001, clean, "en", base.source, len(clean)),
        (900_002, clean, "en", base.source, len(clean)),
        (900_003, clean + " and a bit", "en", base.source, len(clean) + 10),
        (900_004, clean[:500] + ' idiot scum pathetic worthless token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "en", base.source, 960),
        (900_005, 'unlike the others token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and so on for a while', "en", base.source, 90),
    ]
    here = str(tmp_path_factory.mktemp("corpus"))
    docs.unionByName(llm.createDataFrame(planted, docs.schema)).write.parquet(f"{here}/documents.parquet")
    llm.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{here}/labels.parquet")
    out, docs = [], llm.read.parquet(f"{here}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, here).write.parquet(f"{here}/{name.replace(' ', '_')}")
        docs = llm.read.parquet(f"{here}/{name.replace(' ', '_')}")
        out.append((name, docs))
    return dict(out)


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(run):
    names = list(run)
    assert names == ["toxicity", "near duplicates", "secrets", "mix", "pack"]
    for name in names[:-1]:
        assert run[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 900_004 not in ids(run["toxicity"]) and {900_001, 900_002, 900_003, 900_005} <= ids(run["toxicity"])
    kept = ids(run["near duplicates"])
    assert 900_001 in kept and 900_005 in kept and not {900_002, 900_003} & kept
    assert ids(run["secrets"]) == kept and run["secrets"].count() == run["near duplicates"].count()
    text = run["secrets"].where("doc_id = 900005").first()
    assert text.text == f'unlike the others {MASK}" and so on for a while' and text.n_chars == len(text.text)
    assert ids(run["mix"]) <= kept and run["pack"].groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
    assert ids(run["pack"]) == ids(run["mix"])


def stages_over(llm, docs, labels, folder):
    here = str(folder)
    labels.write.parquet(f"{here}/labels.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, here).write.parquet(f"{here}/{name.replace(' ', '_')}")
        docs = out[name] = llm.read.parquet(f"{here}/{name.replace(' ', '_')}")
    return out


def test_odd_rows(llm, docs_of, tmp_path):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, None, None), (2, ""), (3, text), (3, text), (4, text + " more"), (5, "alone in here"), (5, "another of that id"),
            (None, "no id at all"), (6, "long " * 30_000, None), (7, " \n ")]
    docs = docs_of(*rows).withColumns({c: F.lit("x") for c in ("cls", "size", "spans", "root", "piece", "score")})
    labels = llm.createDataFrame([(3, 1, 0), (None, None, None)], "doc_id bigint, quality int, toxic int")
    out = stages_over(llm, docs, labels, tmp_path)
    for name in list(out)[:-1]:
        assert out[name].columns == docs.columns
    assert out["toxicity"].count() == len(rows)
    kept = sorted(str((r.doc_id, (r.text or "")[:12])) for r in out["near duplicates"].collect())
    assert sum(k.startswith(("(3,", "(4,")) for k in kept) == 1
    assert sum(k.startswith("(5,") for k in kept) == 2 and any(k.startswith("(None") for k in kept)
    assert any(k.startswith("(1,") for k in kept) and any(k.startswith("(2,") for k in kept)
    assert out["secrets"].count() == out["near duplicates"].count()
    assert out["pack"].groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_no_rows(llm, docs_of, tmp_path):
    labels = llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = stages_over(llm, docs_of((1, "x")).where("false"), labels, tmp_path)
    assert all(df.count() == 0 for df in out.values())
