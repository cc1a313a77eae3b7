"""A worker's state of one operator does not stay beside the next one's."""

import gc
import sys
import weakref

import numpy as np

from cupola.llm import quality
from cupola.llm.common import forget, per_worker


class Held:
    def __init__(self):
        self.me = self  # a cycle, as a codec and its memo are


def test_forgotten_state_is_freed():
    gc.disable()
    try:
        seen = weakref.ref(per_worker(("test",), Held))
        assert seen() is per_worker(("test",), Held)
        forget()
        assert seen() is None and "_cupola_llm" not in sys.__dict__
        forget()
    finally:
        gc.enable()


def test_scoring_frees_what_was_held(spark):
    import pyarrow as pa

    per_worker(("test",), lambda: np.zeros(10))
    got = list(quality.scorer(quality.Constant(0.5), 0, ["t"], None)(iter([pa.RecordBatch.from_arrays([pa.array(["a", None])], ["t"])])))
    assert got[0].column(1).to_pylist() == [0.5, 0.5] and "_cupola_llm" not in sys.__dict__
