"""The language model is small in a worker: arrays, and texts one by one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tillstone.llm import language_id


@pytest.mark.parametrize("word", ["kata", "katu", "zz"])
def test_the_model_is_arrays(word):
    scores = [np.array([[-1.25, -3.5]], dtype=np.float32), *[np.array([[-2.0, -4.0], [-1.0, -0.5]], dtype=np.float32) for _ in range(language_id.LONGEST)]]
    model = language_id.Model(["aa", "bb"], [({"kata": 0}, scores[0]), *[({g: i for i, g in enumerate(language_id.grams("katu", n)[:2])}, s) for n, s in enumerate(scores[1:], 1)]])
    expected = {"kata": [-1.25, -3.5], "katu": [-1.5 + language_id.BACK_OFF, -2.25 + language_id.BACK_OFF], "zz": [0.0, 0.0]}[word]
    assert model.word(word) == pytest.approx(expected)
    found = language_id.judged(pa.array([word, None, "12"]), language_id._Scores(model))
    assert isinstance(found, pa.StructArray) and found.field("lang").to_pylist()[1:] == ["und", "und"]


def test_fitted_tables_hold_no_lists(spark):
    rows = [(i, "kata kito" if i % 2 else "zemil zoril", "aa" if i % 2 else "bb") for i in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert all(scores.dtype == np.float32 and len(scores) == len(items) for items, scores in model.tables)
    assert set(model.tables[0][0]) == {"kata", "kito", "zemil", "zoril"}
