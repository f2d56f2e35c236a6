"""Operators against plain versions, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF_DIR

from reviewlab.llm import jaccard_join, pii, quality, secrets, substring_dedup
from reviewlab.llm.queries import (
    MODEL,
    QUERIES,
    table,
)
from reviewlab.llm.sentencepiece_bpe import Model

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def plain_pii(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def plain_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def test_pii_query(spark, texts):
    for r in QUERIES["op2_pii"](spark, SF).collect():
        want = plain_pii(texts[r.doc_id])
        assert r.base_sha256 == digest(want)
        assert r.n_email == sum(k == "email" for k, _, _ in want)
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(",")) | {""}


def test_secret_query(spark, texts):
    for r in QUERIES["op9_secret_scan"](spark, SF).collect():
        want = plain_secrets(texts[r.doc_id])
        assert r.base_sha256 == digest(want)
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(",")) | {""}


@pytest.mark.parametrize("letters", ["a1@.-_%+ ", "0123456789. -+()", "AKIA01af=: tokenTOK_pswd\"'"])
def test_base_patterns(letters):
    rng = random.Random(letters)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain_pii(text)
        found = sorted(x[:3] for x in secrets.base_spans(text))
        assert [(secrets.KINDS[k], s, e) for s, k, e in found] == plain_secrets(text)


def test_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000):
        pii.base_spans(text)
        secrets.base_spans(text)
    secrets.Guesser().log10_guesses("ab1" * 20_000)


def test_added_phone():
    """The field finds a phone number again that is written without its plus."""
    rows = []
    rng = random.Random(5)
    for _ in range(300):
        number = f"{rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        other = "".join(rng.choice("0123456789") for _ in range(7))
        rows += pii.examples(f"call +1 ({number} or +1 ({number} code {other} at x")
    field = pii.learn(rows)
    text = "call +1 (042) 555-7845 soon. Later we said 042 555 7845 and code 9876543 too."
    added = [(s["kind"], text[s["start"] : s["end"]]) for s in field.spans([text])[0] if not s["base"]]
    assert added == [("phone", "042 555 7845")]


@pytest.mark.parametrize(
    "value, secret",
    [("changeme", False), ("password123", False), ("qwerty123456", False), ("19870412", False),
     ("Xk9#mP2$vL", True), ("d8Fk2!xQ9z", True), ("aaaaaaaaaaaaaaaa", False)],
)
def test_guesses(value, secret):
    assert (secrets.Guesser().log10_guesses(value) >= secrets.MIN_LOG10) == secret


def test_sentencepiece(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in QUERIES["op7_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("letters", ["ab ", "the in", "0123456789 .", "=-_*# ", "éàß漢▁ a\n", "<s>/0xAF \t"])
def test_sentencepiece_odd(letters):
    library, model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), Model(MODEL), random.Random(1)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(400)]
    texts += [" " * k + "the" for k in range(40)] + ["x" + " " * k for k in range(40)]
    ids = model.encode(texts)
    assert ids.to_pylist() == library.encode(texts)
    assert model.decode(ids.cast(pa.list_(pa.int32()))).to_pylist() == [library.decode(i) for i in ids.to_pylist()]


def test_quality_held_out(spark):
    scored = QUERIES["op8_quality"](spark, SF).join(table(spark, SF, "labels"), "doc_id")
    rows = scored.filter("held_out").collect()
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = [r.score for r in rows if r.quality == 0]
    auc = sum(sum(g > b for g in good) for b in bad) / (len(good) * len(bad))
    assert auc > 0.97
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (2, 60), (1, 95)])
def test_jaccard_groups(spark, n, percent):
    """Documents around the threshold, chains of them, tiny sets, copies."""
    rng, docs = random.Random(n), []
    for size in (1, 2, 5, 6, 7, 8, 12, 20, 40, 90, 200):
        for _ in range(2):
            text = [f"t{rng.randint(0, 3000)}" for _ in range(size)]
            for _ in range(8):
                docs.append(" ".join(text))
                text = list(text)
                for _ in range(rng.randint(0, 1 + size // 40)):
                    text[rng.randrange(size)] = f"t{rng.randint(0, 3000)}"
    sets = [shingles(t, n) for t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    for r in jaccard_join.groups(df, n, percent).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root(r.doc_id))


def plain_runs(text, most=40):
    """(sentences, all runs of up to ``most`` of them that count as repeated if elsewhere)."""
    pieces = [p for p in re.split(r"(?<=[.!?]\s)(?!\s)|(?<=\n)(?!\s)", text)]
    words = [tuple(p.lower().split()) for p in pieces]
    out = []
    for i in range(len(pieces)):
        total = 0
        for j in range(i + 1, min(i + most, len(pieces)) + 1):
            total += len(words[j - 1])
            if total >= (substring_dedup.MIN_SINGLE if j == i + 1 else substring_dedup.MIN_WORDS):
                out.append((tuple(words[i:j]), i, j))
    return pieces, out


def test_substring_dedup(spark, texts):
    first, cut, gone = {}, {}, {}
    for doc in sorted(texts):
        pieces, runs = plain_runs(texts[doc])
        cut[doc], gone[doc] = pieces, set()
        for words, i, j in runs:
            if words in first:
                gone[doc] |= set(range(i, j))
            else:
                first[words] = doc
    removed = 0
    for r in QUERIES["op6_substring_dedup"](spark, SF).collect():
        kept = "".join(p for i, p in enumerate(cut[r.doc_id]) if i not in gone[r.doc_id])
        assert (r.n_removed, r.kept) == (len(gone[r.doc_id]), kept)
        removed += r.n_removed
    assert removed


def test_pipeline(spark, texts):
    """The stages' decisions, held against the operators' results on each stage's input."""
    import corpus_pipeline

    docs = table(spark, SF_DIR, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, SF_DIR, "labels"))).collect()
    kept = {r.doc_id: r.text for r in scored if r.score >= 0.5}
    sets = {i: shingles(t, 5) for i, t in kept.items()}
    drop = set()
    order, group = sorted(kept), {i: i for i in kept}
    for x, i in enumerate(order):
        for j in order[:x]:
            a, b = sets[i], sets[j]
            if a and 100 * len(a & b) >= 80 * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if v == old else v for k, v in group.items()}
    drop = {i for i in kept if group[i] != i}
    left = {i: t for i, t in kept.items() if i not in drop}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    runs = lambda w: {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    bad = set().union(*(runs(words(r.text)) for r in table(spark, SF_DIR, "benchmark").collect()))
    left = {i: t for i, t in left.items() if not runs(words(t)) & bad}
    guesser = secrets.Guesser()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(left)
    for i, t in left.items():
        clean = secrets.masked(t, [(s, e) for s, _, e, _ in secrets.spans(t, guesser)], "[SECRET]")
        assert got[i] == library.encode(clean)
