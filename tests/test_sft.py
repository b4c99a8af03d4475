from pyspark.sql import functions as F

from tessera.functions.text import extract_final_answer
from tessera.operators.sft import evaluate as EV
from tessera.operators.sft import prepare as PR

from shared_cases import one_col


def test_extract_answer_edges(spark):
    cases = [("#### 1,234", "1234"), ("#### 42.", "42."), ("#### -7", "-7"), ("#### $5", "5"),
             ("a 1,200 then 3.5.", "3.5"), ("#### 8 #### 9", "8"), ("v2 3kg 4", "4"),
             ("none", None)]
    df = one_col(spark, [c for c, _ in cases])
    got = [r.a for r in df.select(extract_final_answer("text").alias("a")).collect()]
    assert got == [e for _, e in cases]


def _qa(spark, rows):
    return spark.createDataFrame(rows, "qa_id long, question string, answer string")


def test_label_mask_long_prompt(spark):
    qa = PR.with_prompts(_qa(spark, [(1, "word " * 600, "#### 3"), (2, "short?", "x #### 4")]))
    enc = {r.qa_id: r for r in PR.encode(qa, PR.build_vocab(qa), max_len=512).collect()}
    assert enc[1].n_tokens == 512 and enc[1].n_label_tokens == 0
    assert all(x == -100 for x in enc[1].labels)
    assert enc[2].n_label_tokens > 0
    assert list(enc[2].labels[:enc[2].n_prompt]) == [-100] * enc[2].n_prompt


def test_left_padding(spark):
    qa = PR.with_prompts(_qa(spark, [(i, "q" * (i + 1), "a") for i in range(9)]))
    enc = PR.encode(qa, PR.build_vocab(qa))
    padded = PR.left_pad_batches(enc, batch_size=4, rows_per_bucket=5).collect()
    for r in padded:
        assert len(r.input_ids) == r.padded_len == len(r.attention_mask)
        assert list(r.attention_mask[:r.n_pad]) == [0] * r.n_pad


def test_batches_do_not_depend_on_partitions(spark):
    qa = PR.with_prompts(_qa(spark, [(i, "q" * (i % 5), "a") for i in range(12)]))
    vocab = PR.build_vocab(qa)
    got = [sorted(map(tuple, PR.left_pad_batches(PR.encode(qa.repartition(n), vocab), 4, rows_per_bucket=5)
                      .select("qa_id", "bucket", "batch_no", "padded_len").collect())) for n in (1, 3, 12)]
    assert got[0] == got[1] == got[2]


def test_joined_encoding_equals_broadcast(spark, monkeypatch):
    qa = PR.with_prompts(_qa(spark, [(1, "word " * 600, "#### 3"), (2, "short?", None), (3, None, "x"), (3, "two two", "x")]))
    vocab = PR.build_vocab(qa.where("qa_id = 1"))      # some tokens are unknown
    cols = ["qa_id", "input_ids", "n_prompt", "labels", "attention_mask", "n_tokens", "n_label_tokens"]
    want = sorted(repr(tuple(r)) for r in PR.encode(qa, vocab).select(cols).collect())
    monkeypatch.setattr(PR, "BROADCAST_VOCAB", 1)
    assert sorted(repr(tuple(r)) for r in PR.encode(qa, vocab).select(cols).collect()) == want


def test_next_turn_survives_gaps_and_blocks(spark):
    from tessera.sources.qa import with_next_turn
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(0, 40, 3)]
    conv = spark.createDataFrame(rows + [(2, 7, "user", "x"), (None, 1, "user", "y")],
                                 "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.next_text for r in with_next_turn(conv, block=5).collect()}
    want = {(1, t): f"t{t + 3}" if t < 39 else None for t in range(0, 40, 3)} | {(2, 7): None}
    assert got == want


def test_accuracy_edges(spark):
    truth = _qa(spark, [(1, "q", "#### 5"), (2, "q", "#### 6")])
    preds = spark.createDataFrame([(1, "so #### 5"), (2, None)], "qa_id long, generated string")
    acc = EV.exact_match_accuracy(EV.score_predictions(preds, truth)).first()
    assert (acc.n_total, acc.n_correct, acc.accuracy) == (2, 1, 0.5)
    empty = EV.exact_match_accuracy(EV.score_predictions(preds.limit(0), truth.limit(0))).first()
    assert empty.accuracy == 0.0


def test_best_checkpoint_rule(spark):
    acc = spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.5), (1, 3, 0.5), (1, 4, 0.6)],
                                "run_id long, epoch int, accuracy double")
    got = [r.is_best for r in EV.best_checkpoints(acc).orderBy("epoch").collect()]
    assert got == [False, True, False, True]


def test_loss_rollup_blocks(spark):
    steps = spark.range(1, 121).select(F.col("id").alias("step"), F.lit(2.0).alias("loss"))
    rows = EV.loss_rollup(steps, every=50).orderBy("step").collect()
    assert [(r.step, r.n_steps, r.train_loss) for r in rows] == [(50, 50, 2.0), (100, 50, 2.0),
                                                                  (150, 20, 2.0)]


def test_py_float_str_matches_python_repr(spark):
    import random
    from tessera.functions.text import py_float_str
    rng = random.Random(7)
    vals = [0.0, 28.0, 960.0, 0.3, 0.1 + 0.2, 1 / 3, 1e-4, 9999999999999998.0, 12345.678]
    vals += [round(rng.uniform(-1e6, 1e6), rng.randint(0, 6)) for _ in range(300)]
    vals += [rng.uniform(1e-4, 1e15) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.s for r in df.select(py_float_str("x").alias("s")).collect()]
    assert got == [str(v) for v in vals]


def test_split_sample_and_step_plan(spark):
    qa = spark.range(200).selectExpr("id AS qa_id", "concat('q', id) AS question",
                                     "concat('#### ', id) AS answer")
    split = PR.split_qa(qa).collect()
    train = {r.qa_id for r in split if r.split == "train"}
    ev = {r.qa_id for r in split if r.split == "eval"}
    assert len(train) == 150 and len(ev) == 50 and not (train & ev)
    # seeded order is reproducible and independent of partitioning
    again = PR.split_qa(qa.repartition(7)).collect()
    assert {r.qa_id for r in again if r.split == "train"} == train
    # evaluation rows are not shuffled: the first n by id
    assert [r.qa_id for r in PR.sample_eval(qa, 5).collect()] == [0, 1, 2, 3, 4]
    plan = PR.step_plan(PR.sample_train(qa, 150)).first()
    # 150 samples, batch 4, 3 epochs, accumulation 4
    assert (plan.n_samples, plan.steps_per_epoch, plan.total_steps_trainer,
            plan.total_steps_simulation) == (150, 38, 29, 28)


def test_checkpoint_steps_run_summary_token_stats(spark):
    steps = spark.range(1, 1201).select(F.col("id").alias("step"),
                                        (F.col("id") / 1000.0).alias("loss"))
    assert sorted(r.step for r in EV.checkpoint_steps(steps, every=500).collect()) == [500, 1000]
    rollup = EV.loss_rollup(steps, every=50)
    acc = spark.createDataFrame([(2, 1, 0.5)], "n_total long, n_correct long, accuracy double")
    train = spark.range(150).withColumnRenamed("id", "qa_id")
    ev = spark.range(50).withColumnRenamed("id", "qa_id")
    summ = EV.run_summary(train, ev, rollup, acc).first()
    # final loss = the block ending at the largest step (1,151..1,200 -> mean 1.1755)
    assert (summ.train_samples, summ.eval_samples, summ.final_train_loss, summ.accuracy) == \
        (150, 50, round(sum(range(1151, 1201)) / 50 / 1000.0, 4), 0.5)
    prompts = spark.createDataFrame([("x" * 10,), ("y" * 3,)], "train_prompt string")
    st = PR.token_stats(prompts).first()
    assert (st.n_samples, st.est_tokens_avg) == (2, (13 + 3) / 2)   # int(10*1.3), int(3*1.3)


def test_tokens_of_a_batch_are_those_of_the_column(spark):
    import random

    import numpy as np
    import pyarrow as pa
    from tessera.operators.sft import prepare as PR
    rng = random.Random(4)
    stock = "ab Z_9 \t\n\r\f\x0b.,#\\é你🙂\x1c -"
    texts = ["".join(rng.choice(stock) for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, "", "   ", "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    want = [r.k or [] for r in df.select("i", PR.tokens("t").alias("k")).orderBy("i").collect()]
    counts, flat = PR.cut_batch(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert [flat.to_pylist()[e - n:e] for e, n in zip(ends.tolist(), counts.tolist())] == want


def test_a_batch_with_a_common_head_is_cut_without_it_and_gives_the_same(monkeypatch):
    import random

    import pyarrow as pa
    import pyarrow.compute as pc
    from collections import Counter
    from tessera.operators.sft import prepare as PR

    def cut(text):
        return PR.cut_batch(pa.array([text], pa.string()))[1].to_pylist()

    sizes = []
    plain = PR._cut
    monkeypatch.setattr(PR, "_cut", lambda texts: (sizes.append(pc.sum(pc.binary_length(texts)).as_py()), plain(texts))[1])
    rng = random.Random(6)
    stock = "ab Z_9 \n\t.,#é你🙂-"
    some = lambda most: "".join(rng.choice(stock) for _ in range(rng.randint(0, most)))
    for head in ("", "### System:\nYou are 你 a tutor " * 20, "abc", "abc é", "\n"):
        for rows in (0, 1, 2, 40):
            prompts = [head + some(12) + rng.choice(["\n", "x"]) for _ in range(rows)]
            if rows == 40:
                prompts[3:6] = [None, "", head]
            train = [None if p is None else p + some(30) for p in prompts]
            want = Counter(t for text in train if text for t in cut(text))
            found = Counter()
            for token, n in zip(*(c.to_pylist() for c in PR.count_batch(pa.array(train, pa.string())))):
                found[token] += n
            assert +found == want

            names = pa.array(sorted(want)[::2], pa.string())
            known = {t: i + 3 for i, t in enumerate(names.to_pylist())}
            begun = [p is not None and p.endswith("\n") for p in prompts]
            for max_len in (5, 512):
                got = PR.encode_texts(
                    pa.array(train, pa.string()), pa.array([len(p.encode()) if b else None for p, b in zip(prompts, begun)], pa.int32()),
                    pa.array([None if b else p for p, b in zip(prompts, begun)], pa.string()),
                    lambda flat: pc.fill_null(pc.add(pc.index_in(flat, value_set=names), 3), PR.UNK_ID).to_numpy(), max_len)
                assert got.to_pylist() == [
                    {"input_ids": [known.get(t, PR.UNK_ID) for t in cut(text or "")][:max_len],
                     "n_prompt": min(len(cut(prompt or "")), max_len)} for text, prompt in zip(train, prompts)]
    # the common head goes through the cutting once a batch, not once a row
    sizes.clear()
    texts = pa.array(["### System:\nYou are a tutor " * 20 + str(i) for i in range(1000)], pa.string())
    PR.count_batch(texts)
    assert sum(sizes) < 5000 < pc.sum(pc.binary_length(texts)).as_py()


def test_templated_questions_compile_to_methods_that_the_jvm_optimises(spark, tmp_path):
    import contextlib
    import io
    import re
    from tessera.operators.sft import prepare as PR
    from tessera.sources import qa as QA
    rows = [(7, 1, 5 * n + i, n) for n in range(3) for i in range(5)] + [(None, 1, 5, 5), (3, 2, None, 4)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        PR.with_prompts(QA.synthesize_qa(spark, str(tmp_path))).explain(mode="codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000   # HotSpot interprets methods of more bytes for good
