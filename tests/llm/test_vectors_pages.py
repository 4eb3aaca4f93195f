"""Vector search and web archives against brute force."""

import base64
import hashlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from keycadence.llm import ann, warc


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 12))
    points = [(i, (centres[i % 8] + rng.normal(size=12)).tolist(), "a") for i in range(600)]
    points += [(1000 + i, points[5][1], "same") for i in range(300)]
    bad = [None, [], [0.0] * 12, [float("nan")] * 12, [1.0, None] + [1.0] * 10, [float("inf")] * 12]
    points += [(2000 + i, v, "bad") for i, v in enumerate(bad)] + [(None, [1.0] * 12, "no id")]
    return spark.createDataFrame(points, "vec_id long, embedding array<float>, rank string")


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_nearest(vectors, monkeypatch, shard_rows):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    rows = ann.nearest(vectors, F.col("vec_id") % 20 == 0, 20).collect()
    known = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()
             if r.vec_id is not None and r.vec_id < 2000}
    ids = np.array(sorted(known))
    matrix = np.stack([known[i] for i in ids])
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        mine = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        assert [m[0] for m in mine] == list(range(1, 21)) and query not in {m[1] for m in mine}
        for _, vec_id, score in mine:
            assert abs(score - known[vec_id] @ known[query]) < 1e-12
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        others = ids[ids != query]
        scores = matrix[ids != query] @ known[query]
        worst = np.sort(scores)[-20]
        hits += sum(s >= worst - 1e-12 for _, _, s in mine)
        total += 20
    assert {r.query_id for r in rows} == set(ids[ids % 20 == 0].tolist())
    assert hits / total >= 0.9


def test_few_and_no_vectors(vectors):
    few = vectors.filter("vec_id < 4 OR vec_id >= 2000")
    rows = ann.nearest(few, F.col("vec_id") == 0, 20).collect()
    assert sorted(r.vec_id for r in rows) == [1, 2, 3]
    assert ann.nearest(vectors.limit(0), F.col("vec_id") == 0, 20).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1500, 16))
    graph = ann.Graph(points)
    queries = points[:100]
    ids, far, _ = graph.search(np.column_stack([queries, np.zeros(100)]).astype(np.float32), 64)
    best = np.argsort(-(queries @ points.T), axis=1)[:, :10]
    found = np.take_along_axis(ids, np.argsort(far, axis=1), 1)[:, :10]
    assert np.mean([len(np.intersect1d(a, b)) for a, b in zip(found, best, strict=True)]) >= 9


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i % 9} y", "x" * (i % 7) * 900 if i % 5 else None, 1) for i in range(300)]
    rows += [(400, None, "é<p>\r\n\r\nWARC/1.1", 1), (None, "u", "no id", 1), (None, None, None, 1)]
    rows += [(401, "u", "twice", 1), (401, "u", "twice", 1), (402, "u", "\x1f\x08" * 500, 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int")


def expected(pages):
    rows, last = pages.collect(), {}
    for r in rows:
        if r.page_id is not None:
            key = r.html or ""
            last[key] = max(last.get(key, r.page_id), r.page_id)
    out = []
    for r in rows:
        data = (r.html or "").encode()
        source = last.get(r.html or "")
        revisit = source is not None and source != r.page_id
        mark = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((r.page_id, len(data), mark, "revisit" if revisit else "response",
                    source if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [40, 700, 1 << 20])
def test_ranges_read_every_record_once(pages, tmp_path, size):
    manifest = warc.write_archives(warc.with_revisits(pages), str(tmp_path / "a"))
    rows = warc.read_archives(manifest, size).collect()
    ranges = warc.ranges(manifest, size).count()
    tasks = warc.read_archives(manifest, size).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1 or ranges < 4, "ranges are not read by one task"
    found = sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows),
        key=str,
    )
    assert found == expected(pages)
    stored = {r.page_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert stored[400] == "é<p>\r\n\r\nWARC/1.1".encode()


def test_short_payloads_are_all_responses_and_empty_table(pages):
    rows = warc.archived(pages, least=10).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 10)
    assert warc.archived(pages.limit(0)).count() == 0


def test_member_cut_by_the_read_buffer_is_not_stepped_over():
    data = warc.record(1, "http://a/b", b"some page", None, False)

    class Short(io.BytesIO):
        first = 0

        def read(self, size=-1):
            size, self.first = self.first or size, 0
            return super().read(size)

    for cut in range(10, len(data)):
        file = Short(data)
        file.first = cut
        assert len(list(warc.records_in(file, 0, len(data)))) == 1
