"""The pipeline's stages against brute force, each on its own input, and the queries' wiring."""

from collections import Counter, defaultdict

import helpers as B
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from forecourt.llm.common import staged
from forecourt.llm.queries import ORACLES, QUERIES


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = staged(stage(spark, docs, sf_dir), name)
        after = docs.collect()
        ids = Counter(r.doc_id for r in after)
        if name != "sharding":
            assert docs.columns == columns
        if name == "language_id":
            assert set(ids) == {r["doc_id"] for r in before if any(map(str.isalpha, r["text"] or ""))}
        elif name == "simhash_near_dedup":
            prints = {r["doc_id"]: B.simhash(r["text"]) for r in before}
            part, first = B.components(set(prints.values())), {}
            for i in sorted(prints):
                first.setdefault(part[prints[i]], i)
            assert ids == Counter(first.values())
        elif name == "benchmark_decontamination":
            found = B.hits([r["text"] for r in before], items)
            assert ids == Counter(r["doc_id"] for r, (_, hit, _) in zip(before, found) if not hit)
        elif name == "mixing":
            size, taken, largest = Counter(), Counter(), Counter()
            source = {r["doc_id"]: r["source"] for r in before}
            words = {r["doc_id"]: len(B.words(r["text"])) for r in before}
            for i, n in words.items():
                size[source[i]] += n
                largest[source[i]] = max(largest[source[i]], n)
            for i, n in ids.items():
                assert n <= 2
                taken[source[i]] += n * words[i]
            want = B.targets(size)
            assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in size)
        else:
            slots, loads, where = defaultdict(list), Counter(), defaultdict(set)
            for r in after:
                slots[r.shard].append(r.slot)
                loads[r.shard] += r["size"]
                where[r["size"], r.text_crc32].add(r.shard)
            assert len(after) == len(before) and all(sorted(v) == list(range(len(v))) for v in slots.values())
            assert all(len(v) == 1 for v in where.values()) and max(loads.values()) < 1.2 * sum(loads.values()) / 8


def test_wiring():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    assert set(QUERIES) < set(contract.queries()) and set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and "pipeline" in contract.queries()
