import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import pii_tagger
from millrace.llm.pretokens import default_tokenizer

from .test_fm_index import by_hand as contaminated_by_hand
from .test_simhash import by_hand as fingerprint_by_hand
from .test_simhash import find

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mask", "encode"]

    good = stage["quality"](spark, docs, SF).cache()
    assert good.columns == columns
    now = good.collect()
    assert {tuple(r) for r in now} < {tuple(r) for r in rows} and len(now) > 0.6 * len(rows)

    single = stage["near_dedup"](spark, good, SF).cache()
    fps = {r.doc_id: fingerprint_by_hand(r.text) for r in now}
    top = find([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(top.values()))

    clean = stage["decontaminate"](spark, single, SF).cache()
    left = {r.doc_id: r.text for r in single.collect()}
    dirty = {r[0] for r in contaminated_by_hand(list(left.items()), items, 10) if r[2]}
    assert dirty and sorted(r.doc_id for r in clean.collect()) == sorted(set(left) - dirty)

    masked = stage["mask"](spark, clean, SF).cache()
    assert masked.columns == columns and masked.count() == clean.count()
    out = {r.doc_id: r for r in masked.collect()}
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert not any(pii_tagger.base_spans(r.text) for r in out.values())
    assert all(left[k] == r.text or pii_tagger.base_spans(left[k]) or "<" in r.text for k, r in out.items())

    library = Tokenizer.from_file(default_tokenizer())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stage["encode"](spark, masked, SF).collect()}
    want = {}
    for k, r in out.items():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[k] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert got == want
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()} == want
