"""Blocks of vectors meet without being shuffled or stored again."""

import numpy as np

from colloquy.llm import neardup


def test_pairs_of_blocks_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(neardup, "ROWS", 32)
    kept, stage = {}, neardup.stage

    def noted(df, name):
        kept[name] = (df, out := stage(df, name))
        return out

    monkeypatch.setattr(neardup, "stage", noted)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8))
    x[200:] = x[:200] + rng.normal(size=(200, 8)) * 0.05
    x[17] = x[3] * 2  # one class
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got = {r.key: r.n_links for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    y = np.array([v for _, v in rows])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = (y @ y.T >= 0.9).sum(axis=1) - 1
    assert got == dict(enumerate(want.tolist())) and want.max() > 1
    plan = kept["neardup-links"][0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    blocks = kept["neardup-blocks"][1].collect()
    assert len(blocks) > 10 and sum(len(b.raw) for b in blocks) == 399 * 8 * 4  # each class once, in the column's numbers
