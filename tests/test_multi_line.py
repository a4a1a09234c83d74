from lexispark.config import RunConfig
from lexispark.plans.run import run


def test_run_reads_texts_with_line_ends(spark, tmp_path):
    lines = [f'"good word{i % 3}\nsecond ""line"" {i}",pos' if i % 2 else f'"bad thing{i % 3}\r\n\nmore {i}",neg' for i in range(20)]
    for split in ("train", "test"):
        (tmp_path / f"{split}.csv").write_text("text,label\n" + "\n".join(lines) + "\n", newline="")
    cfg = RunConfig(f"{tmp_path}/train.csv", f"{tmp_path}/test.csv", f"{tmp_path}/out", models="naive_bayes", learning_curves=False)
    summary = run(spark, cfg).tables["run_summary"].first()
    assert (summary.train_size, summary.test_size, summary.n_classes) == (20, 20, 2)
