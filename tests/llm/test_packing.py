import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import queries
from millrace.llm.packing import Places, pack_documents, packed_sequences, slack_plan


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = [len(lengths)]
    order = sorted(lengths, reverse=True)

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(order):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= order[k]:
                rest = list(rooms)
                rest.remove(r)
                go(k + 1, [*rest, r - order[k]])
        go(k + 1, [*rooms, capacity - order[k]])

    go(0, [])
    return best[0]


def size(plan):
    return sum(times for times, _ in plan)


def check_plan(counts, capacity):
    plan = slack_plan(counts, capacity)
    used = Counter()
    for times, one in plan:
        assert times > 0 and sum(n * c for n, c in one.items()) <= capacity
        used.update({n: times * c for n, c in one.items()})
    assert used == Counter({n: c for n, c in counts.items() if c})
    return plan


def test_few_pieces_against_all_ways():
    rng = random.Random(3)
    more = 0
    for _ in range(150):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        got, want = size(check_plan(Counter(lengths), 20)), fewest(lengths, 20) if lengths else 0
        assert want <= got <= want + 1
        more += got - want
    assert more <= 3


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    counts = Counter(min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(50_000))
    plan = check_plan(counts, 2048)
    assert size(plan) == -(-sum(n * c for n, c in counts.items()) // 2048)
    many = check_plan({n: c * 1_000_003 for n, c in counts.items()}, 2048)
    assert len(many) < 3 * len(plan) + 2048
    total = sum(n * c for n, c in counts.items()) * 1_000_003
    assert size(many) <= -(-total // 2048) * 1.0001
    with pytest.raises(ValueError):
        slack_plan({0: 1}, 2048)


def test_one_length_and_halves():
    assert slack_plan({2048: 10**12}) == [(10**12, {2048: 1})]
    assert size(check_plan({1025: 1000, 1023: 999}, 2048)) == 1000
    assert size(check_plan({700: 10}, 2048)) == 5 and slack_plan({}) == []


def test_places_are_gapless():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 300) for _ in range(4000))
    places = Places.of(slack_plan(counts, 300))
    rows = defaultdict(list)
    for n, c in counts.items():
        for s, o in zip(*places(np.full(c, n), np.arange(c)), strict=True):
            rows[int(s)].append((int(o), n))
    assert sorted(rows) == list(range(len(rows)))
    for r in rows.values():
        at = 0
        for o, n in sorted(r):
            assert o == at
            at += n
        assert at <= 300


def lower_bound(lengths, capacity):
    """Pieces over half a sequence lie apart; for each bound k the others from k on fill up what room those leave that can hold them."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(n > capacity - k for n in lengths)
        large = [n for n in lengths if capacity // 2 < n <= capacity - k]
        small = sum(n for n in lengths if k <= n <= capacity // 2)
        room = len(large) * capacity - sum(large)
        best = max(best, alone + len(large) + max(0, -(-(small - room) // capacity)))
    return best


def check_rows(rows, docs, capacity, end_id):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*tok.encode(t or "", add_special_tokens=False).ids, end_id], "<u4") for d, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at) and (r.length == capacity or k == 0) and 0 < r.length <= capacity
            assert r.ids_crc32 == zlib.crc32(ids[d][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[d])
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= capacity
    return len(by_sequence), lower_bound([r.length for r in rows], capacity)


def test_given_documents(spark):
    at = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    rows = queries.QUERIES["op12_slack_packing"](spark, at).collect()
    n, least = check_rows(rows, docs, 2048, 0)
    assert n == least


def test_edge_cases_and_sequences(spark):
    rng = np.random.default_rng(1)
    texts = [None, "", " ", "word " * 3000, "<|endoftext|> é 漢字\n"] + [" ".join(["word"] * int(rng.integers(1, 60))) for _ in range(300)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs] + [(None, "x", 1, 2, 3)], "doc_id long, text string, length int, ids int, _part int").repartition(5)
    packed = pack_documents(df, end_id=7, capacity=64, with_ids=True).cache()
    n, least = check_rows(packed.drop("ids").collect(), docs, 64, 7)
    assert n <= least + 1
    whole = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u2") for r in packed_sequences(packed).collect()}
    assert len(whole) == n
    for r in packed.collect():
        assert (np.frombuffer(bytes(r.ids), "<u2") == whole[r.sequence_id][r.offset : r.offset + r.length]).all()
    assert pack_documents(df.limit(0)).count() == 0
    twice = pack_documents(df.where("doc_id = 3").union(df.where("doc_id = 3"))).collect()
    assert sorted(r.piece for r in twice) == [0, 0, 1, 1] and len({(r.sequence_id, r.offset) for r in twice}) == 4
