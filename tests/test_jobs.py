"""End-to-end jobs on a miniature catalog with local text folders and hub-style Parquet tables."""

import os

from pyspark.sql import functions as F

from corpusmill.plans import jobs
from corpusmill.sources.catalog import catalog_frame

CASE = (
    "Le patient de cinquante ans présente une fièvre élevée depuis trois jours avec une toux sèche, des douleurs "
    "thoraciques et une grande fatigue. Le bilan sanguin montre une hausse des marqueurs de inflammation, la radio "
    "du thorax révèle une opacité basale droite compatible avec une pneumonie communautaire traitée par antibiotiques."
)


def _txt(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_build_dedup_stats(spark, tmp_dir):
    local = os.path.join(tmp_dir, "local")
    lake = os.path.join(tmp_dir, "lake")
    _txt(f"{local}/frasimed/a", "1.txt", CASE)
    _txt(f"{local}/frasimed/b", "2.txt", CASE)  # exact duplicate of 1.txt
    _txt(f"{local}/frasimed/b", "3.txt", "Trop court")  # fails the word gate
    _txt(f"{local}/frasimed/b", "4.txt", CASE.replace("trois", "quatre"))  # near duplicate
    _txt(f"{local}/mqc/Interne1", "dialogues_clean.txt", "Bonjour docteur comment allez vous\nTrès bien merci pour la question\n")
    bank = spark.createDataFrame(
        [("Quel organe filtre le sang chez l'adulte ?", "Le rein", "Le foie", "La rate", "Le coeur", "Le poumon", [0, 1, 2])],
        "question string, answer_a string, answer_b string, answer_c string, answer_d string, answer_e string, correct_answers array<int>",
    )
    bank.write.parquet(f"{lake}/qa/train")
    tokens = spark.createDataFrame([("d1", ["Un", "long", "texte", "clinique"]), ("d1", ["suite", "du", "texte"])], "document_id string, tokens array<string>")
    tokens.write.parquet(f"{lake}/deft/train")
    catalog = catalog_frame(
        spark,
        [
            {"source": "FRASIMED", "path": "frasimed", "data_dir": "French", "source_split": "train", "adaptation_type": "fine-tuning", "commercial_use": True},
            {"source": "MQC", "path": "mqc", "data_dir": "French", "source_split": "train", "adaptation_type": "fine-tuning", "commercial_use": False},
            {"source": "FRENCHMEDMCQA", "path": "qa", "data_dir": None, "source_split": "train", "adaptation_type": "instruction-tuning", "commercial_use": True},
            {"source": "DEFT2021", "path": "deft", "data_dir": None, "source_split": ["train"], "adaptation_type": "fine-tuning", "commercial_use": True},
        ],
    )
    reg = jobs.default_registry(lake, local)
    report = {}
    sourced = jobs.build_sourced(spark, catalog, reg, out_root=f"{tmp_dir}/sourced", make_commercial=False, report=report)
    assert report["FRASIMED"] == {"loaded": 4, "non_empty": 3}  # A9 shapes from observe(), no extra pass
    counts = {r.source: r["count"] for r in sourced.groupBy("source").count().collect()}
    assert counts == {"FRASIMED": 3, "MQC": 1, "FRENCHMEDMCQA": 1, "DEFT2021": 1}
    mqc = sourced.where(F.col("source") == "MQC").first().input
    assert "\n" not in mqc.rstrip("\n")  # lines flattened with spaces

    commercial = jobs.build_sourced(spark, catalog, reg, make_commercial=True)
    assert "MQC" not in {r.source for r in commercial.select("source").distinct().collect()}

    shapes = {}
    ft = jobs.deduplicate(spark, sourced, catalog, "fine-tuning", make_commercial=False, out_root=f"{tmp_dir}/train", report=shapes)
    assert shapes == {"input": 5, "output": 3}
    got = sorted(r.source for r in ft.collect())
    # exact duplicate and near duplicate of the first case are dropped
    assert got == ["DEFT2021", "FRASIMED", "MQC"]
    it = jobs.deduplicate(spark, sourced, catalog, "instruction-tuning", make_commercial=False)
    assert [r.source for r in it.collect()] == ["FRENCHMEDMCQA"]

    stats = {r.label: r for r in jobs.compute_stats(ft, out_csv=f"{tmp_dir}/stats.csv").collect()}
    assert stats["Total"].nb_docs == 3
    assert os.path.isdir(f"{tmp_dir}/stats.csv")
