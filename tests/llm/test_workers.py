"""What travels to workers must load where this package can't be imported."""

import pickle
import subprocess
import sys

import public_tokenizers
import pytest
from pyspark import broadcast, cloudpickle, serializers
from pyspark.sql import functions as F

from sluiceway.llm import (
    bpe,
    hard_negatives,
    language,
    licenses,
    mixing,
    ngram_join,
    periodic_runs,
    pii,
    simhash_tree,
    substring_dedup,
)


def bpe_of(docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.tokenized(docs, ranks, public_tokenizers.PATTERN)


LOADER = """
import importlib.abc, pickle, sys
class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in ("sluiceway", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {name!r}")
sys.meta_path.insert(0, Absent())
import pyspark.core.broadcast
pyspark.core.broadcast._from_id = lambda number: None  # a worker has the values at hand
for made in pickle.load(sys.stdin.buffer):
    pickle.loads(made)
"""


def loads_elsewhere(*pickled):
    done = subprocess.run([sys.executable, "-c", LOADER], input=pickle.dumps(pickled), capture_output=True, cwd="/")
    assert done.returncode == 0, done.stderr.decode()[-800:]


SHARED = "a passage that many documents of this table hold, word for word and letter for letter"


@pytest.fixture
def sent(monkeypatch):
    """All that Spark pickles for workers: functions and broadcast values."""
    kept = []
    dumps, dump = serializers.CloudPickleSerializer.dumps, broadcast.Broadcast.dump
    monkeypatch.setattr(
        serializers.CloudPickleSerializer, "dumps", lambda self, obj: kept.append(dumps(self, obj)) or kept[-1]
    )
    monkeypatch.setattr(
        broadcast.Broadcast, "dump", lambda self, value, f: kept.append(pickle.dumps(value)) or dump(self, value, f)
    )
    return kept


@pytest.mark.parametrize(
    "apply",
    [
        bpe_of,
        language.identify,
        licenses.scan,
        lambda docs: mixing.mix(docs, mixing.five_two_one, 1.5),
        ngram_join.near_duplicates,
        periodic_runs.summarised,
        pii.find,
        simhash_tree.near_duplicates,
        substring_dedup.remove_repeats,
    ],
    ids="bpe language licenses mixing ngram_join periodic_runs pii simhash_tree substring_dedup".split(),
)
def test_what_is_sent_loads_without_the_package(frame, monkeypatch, sent, apply):
    monkeypatch.setattr(substring_dedup, "HOT_IN_SAMPLE", 2)
    monkeypatch.setattr(pii, "STEPS", 5)
    docs = frame([(i, f"{i} {SHARED} {i} +1 (017) 555-7713", "en", "a", 1) for i in range(12)])
    assert apply(docs).count() == 12
    assert sent
    loads_elsewhere(*sent)


def test_vectors_too(spark, sent):
    rows = spark.createDataFrame([(i, [0.1 * i, 1.0], i % 2) for i in range(60)], "vec_id long, embedding array<double>, label int")
    hard_negatives.mine(rows, F.col("label"), F.col("vec_id") % 50 == 0).collect()
    loads_elsewhere(*sent)


def test_nothing_else_is_pickled_by_name():
    def broken():
        return substring_dedup

    with pytest.raises(AssertionError, match="No module named"):
        loads_elsewhere(cloudpickle.dumps(broken))
