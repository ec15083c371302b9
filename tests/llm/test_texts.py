"""Personal data, token counts, toxicity, mixing and packing on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from equigauge.llm.mixing import mix, mixed_documents
from equigauge.llm.packing import pack
from equigauge.llm.pii import find_spans, pii_report, redact
from equigauge.llm.queries import tokenizer_path
from equigauge.llm.token_counts import count_tokens
from equigauge.llm.toxicity import score_toxicity, train, with_scores

from .brute import noisy_or, rows_of

BYTE, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
TEXT_SCHEMA = "doc_id long, text string, pii_found string, size string, score string, taken string"


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if good(m[0])] for k, (p, good) in kinds.items()}


PII = [
    "mail a.b@c.org, x@y.z%q@w.vv.u or @no and no@dot or a@b.c_d@e.f.g", "1.2.3.4 1.2.3.4.5 300.1.1.1 0001.2.3.255 1..2.3.4 9.9.9",
    "4111 1111 1111 1111 x 4111-1111-1111-1112 and 4111111111111111 1 then 6011 0009 9013 9424", "+1 (212) 555-0100. +12 +49 30 1234567890123456 +1--2",
    "😀😀 iban DE89370400440532013000 and DE89370400440532013001; ssn 123-45-6789 but 123-45-6780 not, SSN: 000-12-3456",
    "1" * 3000 + " " + "a" * 3000 + "@" + " " + "1-" * 2000, " ".join(f"u{k}@h{k}.com" for k in range(1500)), None, "",
]


def test_spans_agree_with_plain_patterns(spark):
    rows = [(k, t, "x", "x", "x", "x") for k, t in enumerate(PII)]
    got = {r["doc_id"]: r for r in pii_report(spark.createDataFrame(rows, TEXT_SCHEMA)).collect()}
    for k, text in enumerate(PII):
        want = plain_spans(text)
        base = ",".join(f"{kind}:{a}:{b}" for kind, found in want.items() for a, b in found)
        assert [got[k][f"n_{kind}"] for kind in want] == [len(x) for x in want.values()], k
        assert got[k]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert got[k]["spans"].startswith(base)
    assert re.findall(r"(?:iban|ssn):\d+:\d+", got[4]["spans"]) == ["iban:8:30", "ssn:63:74"]


def test_context_raises_scores_and_redaction_hides(spark):
    docs = spark.createDataFrame([(1, "call +1 212 555 0100"), (2, "xxxx +1 212 555 0100"), (None, "mail me@a.de")], "doc_id long, text string")
    scores = [r["pii_phone"][0]["score"] for r in find_spans(docs).filter("doc_id IS NOT NULL").orderBy("doc_id").collect()]
    assert scores[0] > scores[1]
    assert sorted(r["text"] for r in redact(docs).collect()) == ["call [phone]", "mail [email]", "xxxx [phone]"]


def test_token_counts(spark, odd, odd_rows, empty):
    texts = [*(r[1] or "" for r in odd_rows), "<|endoftext|> a<|endoftext|>b\n\n  c", "don't  WON'T\t\x1c\x85 x ½Ⅷ", "x " * 700]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, None, 1), (0, texts[0], 1)], "doc_id long, text string, n_tokens int")
    tokenizer = Tokenizer.from_file(BYTE)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = [(k, len(t.encode()), count(t), count(t) > 512) for k, t in enumerate(texts)]
    assert rows_of(count_tokens(docs, BYTE)) == sorted([*want, want[0], (None, 0, 0, False)], key=repr)
    assert count_tokens(empty, BYTE).count() == 0


def test_token_counts_do_not_depend_on_the_table(spark, odd):
    assert rows_of(count_tokens(odd, BYTE)) == rows_of(count_tokens(odd.unionByName(odd.limit(0)).repartition(3), BYTE))


@pytest.mark.parametrize("length", [7, 2048])
def test_packing_holds_every_id_once(spark, odd, odd_rows, length):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in odd_rows}
    pieces = pack(odd.repartition(3), WORDS, length).toPandas()
    for doc, want in ids.items():
        mine = pieces[pieces["doc_id"] == doc].sort_values("start")
        starts, lengths = mine["start"].to_numpy(), mine["length"].to_numpy()
        assert starts.tolist() == (np.cumsum(lengths) - lengths).tolist()
        assert lengths.sum() == len(want) == mine["doc_tokens"].iloc[0]
        whole = np.array(want, "<u4")
        assert mine["ids_crc32"].tolist() == [zlib.crc32(whole[a:a + n].tobytes()) for a, n in zip(starts, lengths)]
    lengths = pieces["length"].to_numpy()
    first = np.repeat((pieces["sequence_id"] * length + pieces["offset"]).to_numpy() - (np.cumsum(lengths) - lengths), lengths)
    assert np.array_equal(np.sort(first + np.arange(lengths.sum())), np.arange(sum(map(len, ids.values()))))
    assert (pieces["offset"] + pieces["length"] <= length).all()


def test_packing_of_nothing_and_of_repeated_rows(spark, empty):
    assert pack(empty, WORDS).count() == 0
    docs = spark.createDataFrame([(None, "a b", 1), (1, None, 1), (1, None, 1)], "doc_id long, text string, offset int")
    assert sorted(p["length"] for p in pack(docs, WORDS).collect()) == [1, 1, 3]


def test_mixing_fills_targets(spark, odd, empty):
    got = mix(odd).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    total = sum(r["size"] for r in got)
    weights = dict(zip(sorted((s for s in by if s is not None)), [3, 1, 2, 3, 1, 2])) | {None: [3, 1, 2][(len(by) - 1) % 3]}
    caps = {s: 2 * rows[0]["source_size"] for s, rows in by.items()}
    target = dict.fromkeys(by, 0.0)
    open_, left = set(by), 1.5 * total
    while open_:  # clamp and share again
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= caps[s]}
        if not full:
            target |= {s: level * weights[s] for s in open_}
            break
        target |= {s: float(caps[s]) for s in full}
        left -= sum(caps[s] for s in full)
        open_ -= full
    for s, rows in by.items():
        assert rows[0]["source_size"] == sum(r["size"] for r in rows)
        assert rows[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in rows) - target[s]) <= 0.5
    assert rows_of(mix(odd)) == rows_of(mix(odd.repartition(5)))
    assert mix(empty).count() == 0


def test_mixed_documents_repeat_rows(spark, odd):
    clash = odd.withColumn("taken", F.lit(1)).withColumn("slot", F.lit(2))
    out = mixed_documents(clash)
    assert out.columns == clash.columns
    times = {r["doc_id"]: r["repeats"] for r in mix(odd.withColumn("doc_id", F.sha2(F.to_json(F.struct("doc_id", "text", "source")), 256)))
             .join(odd.select(F.col("doc_id").alias("was"), F.sha2(F.to_json(F.struct("doc_id", "text", "source")), 256).alias("doc_id")), "doc_id")
             .select(F.col("was").alias("doc_id"), "repeats").collect()}
    counted = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counted == {d: n for d, n in times.items() if n}


def test_toxicity_finds_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    told = score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in told) / len(told)
    found = [r["predicted"] for r in told if r["toxic"]]
    assert right >= 0.95 and sum(found) / len(found) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in told)


def test_scores_agree_with_the_plain_noisy_or(spark, odd, odd_rows):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    weights = train(docs, labels)
    assert len(weights) > 10 and weights[""] < 0
    for table, rows in ((docs, [(r["doc_id"], r["text"]) for r in docs.collect()]), (odd, odd_rows)):
        got = {r["doc_id"]: r for r in with_scores(table, weights).collect()}
        for doc, text, *_ in rows:
            score, offending = noisy_or(text, weights)
            assert got[doc]["toxicity_score"] == pytest.approx(score, abs=1e-9), doc
            assert (got[doc]["toxicity_sentences"] or "") == offending, doc
    told = {r["doc_id"]: r for r in score_toxicity(docs, labels).collect()}
    assert any(r["predicted"] for r in told.values())
    for r in docs.collect():
        score, offending = noisy_or(r["text"], weights)
        assert (told[r["doc_id"]]["score"], told[r["doc_id"]]["predicted"], told[r["doc_id"]]["offending"]) == (pytest.approx(score, abs=1e-9), int(score >= 0.3), offending)


def test_training_rows_and_bytes_are_bounded_before_they_are_gathered(spark):
    rows = [(k, ("bad stuff" if k % 2 else "fine words") + " more" * (k % 5)) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    long = spark.createDataFrame([(k, t + " longer" * 500) for k, t in rows] * 3, "doc_id long, text string")
    assert train(docs, labels) == train(docs.union(long), labels)  # one text per id, the shortest
    assert train(docs, labels, most_bytes=0) == {"": -20.0}
    assert train(docs, labels, most_bytes=400) != train(docs, labels)


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(k, 1 if k == 18 else 0, None) for k in range(1, 20)] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    got = {r["doc_id"]: r for r in score_toxicity(odd, labels).collect()}
    assert len(got) == 19 and got[1]["score"] == got[2]["score"] == 0.0
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert score_toxicity(empty, labels).count() == 0
    assert score_toxicity(odd, labels.limit(0)).filter("predicted = 1").count() == 0
