"""What a result leaves in the shared folder."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import minhash_dedup, substring_dedup
from tillflow.llm.storage import scratch, written
from tillflow.sources.workspace import file_system


def _folders(spark):
    system, place = file_system(spark, spark.conf.get("spark.checkpoint.dir"))
    return {f.getPath().getName() for f in system.listStatus(place)} if system.exists(place) else set()


def test_scratch_removes_what_is_not_kept(spark):
    before = _folders(spark)
    with pytest.raises(ValueError):
        with scratch(spark):
            written(spark.range(3), "lost")
            raise ValueError
    with scratch(spark) as keep_outer:
        with scratch(spark) as keep:
            gone, inner = written(spark.range(3), "gone"), keep(written(spark.range(5), "inner"))
            assert gone.count() == 3
        outer = keep_outer(written(inner.where("id > 1"), "outer"))
    assert outer.count() == 3
    assert {name.split("-")[0] for name in _folders(spark) - before} == {"outer"}


def test_few_columns_are_left_of_near_documents_and_passages(spark):
    rng = np.random.default_rng(41)
    draw = lambda n: [f"w{x}" for x in rng.integers(10**6, size=n)]
    group = draw(300)
    texts = [(k, " ".join(group[:k] + draw(2) + group[k:])) for k in range(8)]
    passage = draw(80)
    texts += [(20 + k, " ".join(draw(40) + passage)) for k in range(4)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for run, left in (
        (minhash_dedup.one_of_each, {"text-groups"}),
        (substring_dedup.without_repeats, {"first-texts", "passages"}),
    ):
        before = _folders(spark)
        result = run(df)
        assert {name.rpartition("-")[0] for name in _folders(spark) - before} <= left
        assert result.select(F.count("*")).first()[0] > 0
