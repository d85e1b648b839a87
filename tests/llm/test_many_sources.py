"""Every source keeps its share, however many there are."""

from collections import defaultdict

from tests.llm import shared
from tests.llm.test_packing import PATH, check
from tracelark.llm import packing


def test_shares_and_targets_beyond_the_largest_sources(spark):
    rows = [(i, shared.prose(i, 150 if i % 30 < 3 else 30), f"s{i % 30}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = packing.pack(docs.repartitionByRange(3, "source"), PATH, 256, quantum=1).collect()
    windows = check(found, [(r[0], r[1]) for r in rows], 256)
    total, shares, given = sum(r.length for r in found), defaultdict(int), defaultdict(int)
    for r in found:
        shares[r.source] += r.length
    for number in range(len(windows) - 1):
        for r in windows[number]:
            given[r.source] += r.length
        for source, size in shares.items():  # no deficit reaches three tokens
            assert abs(given[source] - 256 * (number + 1) * size / total) < 3
    found = packing.pack(docs, PATH, 256, quantum=1, targets={"s29": 0.25}).collect()
    windows = check(found, [(r[0], r[1]) for r in rows], 256)
    assert sum(r.length for r in windows[0] if r.source == "s29") > 45
