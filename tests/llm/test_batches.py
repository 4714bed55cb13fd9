import pyarrow as pa
import pytest

from hourglass.llm import _shared, bpe, minhash, quality
from hourglass.llm.queries import tokenizer_path

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

STEPS = {
    "bpe": lambda spark, docs: bpe.encode_documents(spark, docs, tokenizer_path()),
    "quality": lambda spark, docs: quality.measured(docs.select("doc_id", "lang", docs["text"].alias("_text"))),
    "minhash": lambda spark, docs: minhash.sketches(docs, 5),
}


def batch_bytes(docs):
    """Bytes and rows of each Arrow batch that a task's function gets."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64()), pa.array([b.num_rows], pa.int64())], names=["size", "n"])

    return [tuple(r) for r in docs.coalesce(1).mapInArrow(run, "size long, n long").collect()]


@pytest.fixture()
def default_conf(spark):
    spark.conf.unset(KEY)
    yield spark.conf
    spark.conf.unset(KEY)


@pytest.mark.parametrize("step", STEPS)
def test_whole_texts_reach_the_tasks_in_small_batches(spark, make_docs, default_conf, step):
    docs = make_docs([(i, f"w{i} " * 1500) for i in range(3000)])
    docs.count()
    out = STEPS[step](spark, docs)
    sizes = batch_bytes(docs)
    assert sum(n for _, n in sizes) == 3000
    assert max(s for s, _ in sizes) <= 1.5 * _shared.BATCH_BYTES
    assert out.count() == 3000


def test_a_limit_of_the_session_stays(spark, default_conf):
    default_conf.set(KEY, "1m")
    _shared.bounded_batches(spark)
    assert default_conf.get(KEY) == "1m"
