"""The paged list as a data source: batches, streams that go on, and lists of all lengths."""

import pytest

from dockmill.sources import api, paged
from dockmill.sources.paged import FolderReplay, _Pages, _Reader, listed, page_url

SIZE = 5


def write(folder, n, object_id="O"):
    """Pages of a list of ``n`` comments; the page behind a full last one is empty."""
    replay = FolderReplay(f"file://{folder}")
    for page in range(1, n // SIZE + 2):
        rows = [{"id": f"C{i}", "n": i} for i in range((page - 1) * SIZE + 1, min(page * SIZE, n) + 1)]
        replay.keep(page_url("b", object_id, page, SIZE), {"data": rows})
    return replay


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 50, 63, 200])
def test_lengths_take_few_requests(n):
    asked = []

    class Counted(api.Replay):
        def __call__(self, url):
            asked.append(url)
            return super().__call__(url)

    answers = {page_url("b", "O", p, SIZE): {"data": [{"id": str(i)} for i in range((p - 1) * SIZE, min(p * SIZE, n))]} for p in range(1, n // SIZE + 2)}
    pages = _Pages(Counted(answers), "b", "O", SIZE)
    assert pages.length() == n and len(asked) <= 2 * (n // SIZE + 2).bit_length() + 2
    assert pages.length(n) == n
    runs = _Reader(pages, 2).runs(1, n)
    assert [i for r in runs for i in range(r.first, r.last + 1)] == [*range(1, n + 1)] and all(r.last - r.first < 2 * SIZE for r in runs)


def test_batch_and_resumed_stream(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    replay = write(tmp_path / "pages", 23)
    rows = listed(spark, "b", "O", replay, page_size=SIZE, pages=2)
    assert rows.rdd.getNumPartitions() == 3 and [(r.id, r.ord) for r in rows.orderBy("ord").collect()] == [(f"C{i}", i) for i in range(1, 24)]

    def go_on():
        stream = listed(spark, "b", "O", replay, page_size=SIZE, pages=2, stream=True)
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r.ord for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert go_on() == [*range(1, 24)]
    write(tmp_path / "pages", 31)
    assert go_on() == [*range(1, 32)]  # a new query on the old checkpoint reads the new rows only
    assert go_on() == [*range(1, 32)]


def test_an_empty_list_and_failures_with_reasons(spark, tmp_path):
    (tmp_path / "p").mkdir()
    replay = write(tmp_path / "p", 0)
    assert listed(spark, "b", "O", replay, page_size=SIZE).count() == 0
    replay.keep("b/comments/1?include=attachments", {"data": {"attributes": {"comment": "x"}}})
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    assert [r.id for r in api.fetch_details(ids, "b", replay).collect()] == ["1"]
    told = {r.id: r.error for r in api.fetch_details(ids, "b", replay, report=True).collect()}
    assert told["1"] is None and told["2"].startswith("FileNotFoundError")
