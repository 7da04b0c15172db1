import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import TABLES, rows, twin

from chatloom.plans import training  # noqa: F401
from chatloom.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql_twin(spark, name):
    assert rows(QUERIES[name](spark, SF)) == twin(ORACLE[name], SF)


def test_documents_from_lines_with_odd_rows_equals_its_sql(spark, tmp_path):
    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    (tmp_path / "documents.parquet").unlink()
    texts = ["", "  ", "\n\t", "\u2003\x85", None, " a\r\nb\u2028 ", 'q"\\', "\x00x", "\u200bz"]
    odd = [(i, t) for i, t in enumerate(t for t in texts for _ in range(4))] + [(None, "no number"), (None, " "), (-5, "c"), (-8, "d"), (1, "a"), (1, "a")]
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in odd], pa.int64()), "text": [t for _, t in odd]}), tmp_path / "documents.parquet")
    assert rows(QUERIES["documents_from_lines"](spark, str(tmp_path))) == twin(ORACLE["documents_from_lines"], str(tmp_path))
