from helpers import DATA

from lexmill.plans.files import review_queue


def test_violations_are_found_once(spark):
    """Two turns and the decisions read the warnings that were written, and not the documents again."""
    read = {f.rsplit(".parquet", 1)[0].rsplit("/", 1)[-1] for f in review_queue(spark, DATA).inputFiles()}
    assert "orders" in read and "documents" not in read
