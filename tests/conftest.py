import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagetables import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def extract(spark):
    """Tables of one page of markup, as a list of dicts."""
    from pagetables.corpus import page_documents

    def run(*pages, **options):
        frame = spark.createDataFrame(
            [(i, f"p{i}", html) for i, html in enumerate(pages)],
            "doc_id bigint, source string, html string",
        )
        rows = page_documents(frame, **options).orderBy("doc_id").collect()
        return [r.asDict(recursive=True) for r in rows]

    return run
