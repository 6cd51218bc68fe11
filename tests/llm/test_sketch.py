import numpy as np
import pyarrow as pa
import pytest

from tracelake.llm import sketch as S


@pytest.mark.parametrize("n, fan", [(0, 32), (500, 32), (500, 2), (200_000, 2)])
def test_marks_equal_counts(spark, monkeypatch, n, fan):
    monkeypatch.setattr(S, "FAN", fan)
    monkeypatch.setattr(S, "FLUSH", 10_000)
    cells = np.random.default_rng(n).integers(0, 1 << 17, n)
    df = spark.createDataFrame([(int(c),) for c in cells], "c long").repartition(7)

    def run(batches):
        partial = S.Partial(17)
        for b in batches:
            for row in range(2):
                partial.add(row, (b.column(0).to_numpy() + row) % (1 << 17))
            yield from partial.batches(False)
        yield from partial.batches()

    counts = np.bincount(cells, minlength=1 << 17)
    for least in (1, 2):
        first, second = S.marks(df.mapInArrow(run, S.SCHEMA), 7, 2, 17, least)
        assert (S.marked(first, np.arange(1 << 17)) == (counts >= least)).all()
        assert (S.marked(second, np.arange(1 << 17)) == (np.roll(counts, 1) >= least)).all()
    assert isinstance(run([pa.RecordBatch.from_pydict({"c": [1]})]).__next__(), pa.RecordBatch)
