"""The trained detector, early stopping, and one rate for a whole job."""

import os

from pyspark.sql import functions as F

from textmill.operators import language_model, learning


def test_language_model(spark):
    lines = {"en": "the house and the garden of the king were there that day ", "de": "das haus und der garten des königs waren an diesem tag da "}
    rows = [(i, x, lines[x] * (1 + i % 3)) for i, x in enumerate(["en", "de"] * 10)] + [(99, None, "no language at all"), (98, "en", None)]
    model = language_model.train(spark.createDataFrame(rows, "id int, language string, text string"))
    odd = [(1, "und der könig war in dem haus und in dem garten am abend"), (2, "THE KING WAS IN THE GARDEN, and the day was there: of the house"), (3, "short"), (4, None), (5, "12345 " * 20), (6, "")]
    got = {r.id: r for r in model.detect(spark.createDataFrame(odd, "id int, text string")).collect()}
    assert [got[k].language for k in range(1, 7)] == ["de", "en", "unknown", "unknown", "unknown", "unknown"]
    assert got[1].confidence > 0.9 and got[3].confidence == 0.0
    none = language_model.train(spark.createDataFrame([], "id int, language string, text string"))
    assert none.detect(spark.createDataFrame(odd, "id int, text string")).where("language <> 'unknown'").count() == 0


def test_trigrams(spark):
    df = spark.createDataFrame([("Ab, c",), ("",), ("1",), (None,), ("ü",)], "x string")
    assert [r[0] for r in df.select(language_model.trigrams("x")).collect()] == [[" ab", "ab ", "b c", " c "], None, None, None, [" ü "]]


def test_a_later_worse_round_is_not_chosen():
    scores = {1: 0.2, 2: 0.7, 4: 0.6, 8: 0.7, 16: 0.9}
    model, history = learning.best_of(list(scores), lambda k: f"model {k}", lambda m: scores[int(m.split()[1])], patience=2)
    assert model == "model 2" and history == [(1, 0.2), (2, 0.7), (4, 0.6), (8, 0.7)]  # stopped before 16
    assert learning.best_of([1, 2], lambda k: k, float, patience=2)[0] == 2


def test_early_stopping_trains_a_whole_model(spark):
    rows = [(("good text and more" if i % 2 else "bad words here") + f" {i}", ["bad", "good"][i % 2], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, label string, index int")
    weights = learning.class_weights(df, learning.label_map(spark, ("bad", "good")), "label")
    model, history = learning.train_early_stopping(df, df, weights, "label", 64, rounds=(1, 2, 4, 8, 16))
    assert len(history) >= 3 and max(f for _, f in history) == learning.scores(model.transform(df), "index").first()["macro_f1"] == 1.0


def test_one_rate_for_the_whole_job(spark, tmp_path):
    """Whatever the number of tasks, no window of time has more calls than the rate allows."""
    log = str(tmp_path / "calls")

    def service(prompts):
        import time

        with open(log, "a") as f:
            f.write(f"{time.time()} {os.getpid()}\n")
        return learning.stub_labeller(prompts)

    rows = spark.range(40).select(F.col("id").cast("string"), F.lit("p").alias("prompt"))
    got = learning.label_at_rate(rows, service, per_minute=600, parallel=3, least_delay_s=0.2).collect()
    assert len(got) == 40 and all(r.document_type for r in got)
    calls = sorted(float(x.split()[0]) for x in open(log))
    assert len(calls) == 40 and len({x.split()[1] for x in open(log)}) <= 3
    for k in range(len(calls)):
        assert sum(calls[k] <= t < calls[k] + 0.95 for t in calls) <= 11  # ten a second; sleeping is not exact
    assert calls[-1] - calls[0] >= 3.7


def test_labels_of_finished_batches_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text(f'{{"id": "a{k}", "prompt": "p"}}\n{{"id": "b{k}", "prompt": "p"}}')
    asked = str(tmp_path / "asked")

    def service(prompts):
        with open(asked, "a") as f:
            f.write("x" * len(prompts))
        if os.path.getsize(asked) == 4 and not os.path.exists(asked + "-down"):
            open(asked + "-down", "w").close()
            raise OSError("the service is down")
        return learning.stub_labeller(prompts)

    def run():
        stream = spark.readStream.schema("id string, prompt string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        return learning.label_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), service, per_minute=60_000, parallel=1, least_delay_s=0)

    try:
        run()
    except Exception:
        pass
    run()
    got = sorted(r.id for r in spark.read.schema("id string, batch int").json(str(tmp_path / "out")).collect())
    assert got == ["a0", "a1", "a2", "b0", "b1", "b2"] and os.path.getsize(asked) <= 8  # the first batch was asked once
