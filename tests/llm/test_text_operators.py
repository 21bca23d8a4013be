"""Small tests of the text operators: brute force, libraries, and the defined odd cases."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loopweave.llm import (
    byte_bpe,
    common,
    exact_dedup,
    fingerprints,
    html_text,
    jaccard_join,
    language_id,
    packing,
    pii,
    queries,
    sentence_piece,
    token_counts,
    toxicity,
)

SCHEMA = "doc_id long, text string, id string, row long, label string"  # the last three clash with names used inside
TEXTS = [
    None,
    "",
    " ",
    "one two three",
    "One two THREE",
    "a b c d e f g h i j k l",
    "word " * 3000,
    "Ünïcode  über\tall\n\nlines. And 中文 text! " * 20,
    "<|endoftext|> and <s>",
    "x" * 5000,
]


def frame(spark, texts=TEXTS, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", None, None) for i, t in zip(ids, texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def spec():
    return queries.tokenizer_file()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# -- common ----------------------------------------------------------------------------------------


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (20, 21), (21, 22), (22, 23), (23, 24)]
    df = spark.createDataFrame([(str(a).zfill(2), str(b).zfill(2)) for a, b in links], "a string, b string")
    got = {r["node"]: r["root"] for r in common.components(df).collect()}
    assert got == {"01": "01", "02": "01", "03": "01", "09": "01", "05": "05", "06": "05"} | {str(x): "20" for x in range(20, 25)}


def test_key_filter_has_no_false_negatives(spark):
    keys = spark.range(0, 500, 7).select(F.xxhash64("id").alias("k"))
    rows = spark.range(500).select("id", F.xxhash64("id").alias("k"))
    flagged = common.flag_keys(rows, "k", common.key_filter(keys, "k", 4), "f", 4).collect()
    assert all(r["f"] for r in flagged if r["id"] % 7 == 0)
    assert sum(r["f"] for r in flagged if r["id"] % 7) < 20


# -- exact dedup -----------------------------------------------------------------------------------


def test_exact_dedup(spark):
    texts = ["Same", "sAME", "same ", None, "", "Ä", "ä", "a" * 300 + "x", "A" * 300 + "y", "same"]
    rows = exact_dedup.exact_dedup(frame(spark, texts), digest_all=True).collect()
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows}
    assert got[0] == got[1] == (9, 3, False) and got[9] == (9, 3, True)
    assert got[3] == (4, 2, False) and got[4] == (4, 2, True)
    assert all(got[i] == (i, 1, True) for i in (2, 5, 6, 7, 8))
    assert {r["doc_id"]: r["text_sha256"] for r in rows}[0] == hashlib.sha256(b"same").hexdigest()


def test_exact_dedup_ids_that_repeat_or_are_null(spark):
    df = frame(spark, ["t"] * 4 + ["u"] * 2, [5, 5, None, 3, None, None])
    rows = exact_dedup.exact_dedup(df).collect()
    assert len(rows) == 6 and sum(r["kept"] for r in rows) == 2
    assert {(r["keep_id"], r["group_size"]) for r in rows} == {(5, 4), (None, 2)}
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


# -- pii -------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def test_pii_formats_and_links(spark):
    texts = [
        "Mail jane.doe99@mail.example.com or +1 (212) 555-0199.",
        "Again jane.doe99@mail.example.com, card 4111-1111-1111-1111 and 4111 1111 1111 1111!",
        "Not a card 4111111111111112, ip 10.0.0.256 no, 10.0.0.25 yes, ssn 219-09-9999, no 000-12-3456",
        "IBAN DE89370400440532013000 born 1980-02-29 or 29.02.1980, not 2023-02-30",
        "v6 2001:0db8:85a3:0000:0000:8a2e:0370:7334 plain words 12 and 2024",
        None,
        "",
    ]
    out = {r["doc_id"]: r for r in pii.pseudonymise(frame(spark, texts), "k", found_col="found").collect()}
    mails = [re.search(r"\S+@\S+\.com", out[i]["text"])[0] for i in (0, 1)]
    assert mails[0] == mails[1] != "jane.doe99@mail.example.com" and re.fullmatch(r"[a-z]{4}\.[a-z]{3}\d\d@mail\.example\.com", mails[0])
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}\.", out[0]["text"]) and "555-0199" not in out[0]["text"]
    cards = re.findall(r"\d{4}[- ]\d{4}[- ]\d{4}[- ]\d{4}", out[1]["text"])
    assert len(cards) == 2 and cards[0].replace("-", "") == cards[1].replace(" ", "") != "4111111111111111"
    assert luhn(cards[0].replace("-", ""))
    third = out[2]["text"]
    assert "4111111111111112" in third and "10.0.0.256" in third and "000-12-3456" in third
    assert "10.0.0.25 yes" not in third and "219-09-9999" not in third
    iban = re.search(r"DE\d{20}", out[3]["text"])[0]
    assert iban != "DE89370400440532013000" and int(iban[4:] + "1314" + iban[2:4]) % 97 == 1
    assert "1980" not in out[3]["text"].replace("2023-02-30", "") and "2023-02-30" in out[3]["text"]
    assert "2001:0db8" not in out[4]["text"] and out[4]["text"].endswith("plain words 12 and 2024")
    assert out[5]["text"] is None and out[6]["text"] == "" and out[6]["label"] is None
    assert pii.pseudonymise(empty(spark), "k").count() == 0


def test_feistel_is_a_permutation(spark):
    rows = spark.range(17 * 40).select(F.col("id"), F.array((F.col("id") / 40).cast("long"), F.col("id") % 40).alias("v"))
    out = rows.select(pii.feistel(F.col("v"), F.array(F.lit(17).cast("long"), F.lit(40).cast("long")), "key", "t").alias("w"))
    values = [tuple(r["w"]) for r in out.collect()]
    assert len(set(values)) == 17 * 40 and all(0 <= a < 17 and 0 <= b < 40 for a, b in values)
    assert sum(i == a * 40 + b for i, (a, b) in enumerate(values)) < 10


# -- tokens and packing ----------------------------------------------------------------------------


@pytest.mark.parametrize("limits", [(1 << 16, 1 << 15, 256), (200, 100, 20), (64, 40, 4)])
def test_token_counts(spark, spec, library, limits):
    texts = TEXTS + ["foo   bar\n\n baz " * 100, "l'état  c'est  moi 123,45 " * 50, "日本語テキスト" * 100]
    got = {r["doc_id"]: r for r in token_counts.token_counts(frame(spark, texts), spec, "doc_id", "text", *limits).collect()}
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(t or "", add_special_tokens=False).ids), (i, limits)
        assert got[i]["n_bytes"] == len((t or "").encode())
    assert token_counts.token_counts(empty(spark), spec).count() == 0


def test_packing_is_whole(spark, spec, library):
    texts = TEXTS + [" ".join(f"w{i * k}" for i in range(40 * k)) for k in range(1, 40)]
    ids = [*range(len(texts) - 1), None]
    rows = packing.pack(frame(spark, texts, ids), spec, window=256).collect()
    sequences: dict = {}
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in zip(ids, texts):
        want = library.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = np.array(want[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(want)
            at += r["length"]
        assert at == len(want)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 256
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.pack(empty(spark), spec).count() == 0


def test_a_text_of_new_words_is_one_call_of_the_library(spec, library, monkeypatch):
    bpe, calls = byte_bpe.ByteBpe(spec), []
    ids = bpe.ids
    monkeypatch.setattr(bpe, "ids", lambda text: (calls.append(text), ids(text))[1])
    text = " ".join(f"word{i}" for i in range(3000))
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(calls) == 1


def test_plan_places_every_piece_with_little_padding():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(5.5, 1, 20_000).astype(int) + 1, 2048)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    packed = packing.plan(histogram)
    placed: dict = {}
    for pattern, times in packed:
        assert sum(pattern) <= 2048 and times > 0
        for n in pattern:
            placed[n] = placed.get(n, 0) + times
    assert placed == histogram
    assert lengths.sum() / (2048 * sum(t for _, t in packed)) > 0.99


# -- sentence pieces -------------------------------------------------------------------------------


def test_sentence_piece_matches_its_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = queries.piece_table()
    texts = TEXTS + ["  two  spaces ", "a\x00b\x00", "é😀 emoji", "\n \t x", "the " * 5 + "antidisestablishmentarianismsandsoon"]
    encoded = sentence_piece.encode(frame(spark, texts), pieces)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert all(got[i] == library.encode(t or "") for i, t in enumerate(texts))
    back = {r["doc_id"]: r["text"] for r in sentence_piece.decode(encoded, pieces).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert sentence_piece.encode(empty(spark), pieces).count() == 0


def test_viterbi_fold_against_brute_force(spark):
    table = {"▁": -2.0, "a": -3.0, "b": -3.1, "ab": -2.5, "▁ab": -2.2, "bab": -5.2, "ba": -2.4, "aba": -4.9}
    ids = {p: i + 1 for i, p in enumerate(table)}
    words = ["▁abab", "▁b", "xa", "ababab", "▁", "▁babx"]

    def best(word):
        if not word:
            return 0.0, []
        options = [
            (best(word[:-n])[0] + table[word[-n:]], best(word[:-n])[1] + [ids[word[-n:]]])
            for n in range(1, len(word) + 1)
            if word[-n:] in table
        ]
        if word[-1] not in table:
            options.append((best(word[:-1])[0] + min(table.values()) - 10, best(word[:-1])[1] + [0]))
        return max(options)

    pieces = spark.createDataFrame([(p, ids[p], s) for p, s in table.items()], "piece string, id int, score double")
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["ids"] for r in sentence_piece.encode_words(df, pieces).collect()}
    score = {i: table[p] for p, i in ids.items()} | {0: min(table.values()) - 10}
    for w in words:
        assert math.isclose(sum(score[i] for i in got[w]), best(w)[0])


# -- language --------------------------------------------------------------------------------------


def test_language(spark):
    import random

    rng = random.Random(3)
    parts = {"aa": ["tha", "ing", "ou", "er"], "bb": ["ción", "ado", "mente", "os"]}
    rows = [(i, " ".join(rng.choice(p) + rng.choice(p) for _ in range(40)), lang) for lang, p in parts.items() for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    asked = spark.createDataFrame(
        [(1, "thaing outha ering"), (2, "ciónado mentemente osos"), (3, None), (4, ""), (5, "12 34 !"), (6, "ering " * 200_000)],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(asked, model).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["aa", "bb", "und", "und", "und", "aa"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert all(r["lang_pred"] == "und" for r in language_id.identify(asked, None).collect())
    assert language_id.identify(asked.limit(0), model).count() == 0


def test_kneser_ney_sums_to_one():
    model = language_id.KneserNey(["abracadabra arbadacarba", "banana"], 3)
    letters = [g[0] for g in model.count[1]]
    uniform = 1 / (len(letters) + 1)
    for context in [(), (ord("a"),), (ord("a"), ord("b"))]:
        total = sum(model.probability((*context, c), uniform) for c in letters)
        assert 0.8 < total <= 1 + 1e-9  # the rest is left to letters never met


# -- html ------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Menu</a></li></ul></nav><div class="ad">Buy</div><article><h1>Head &amp; line</h1>
<p>First <b>bold</b>,  text<br>more.<p>Second &lt;tag&gt;<div class="comments"><p>Reader</p></div><form>F</form></article>
<footer>&copy; foot</footer></body></html>"""


def test_main_text(spark):
    pages = [PAGE, None, "", "<p>open", "plain & simple", "<article><p>x</p>", "<div id='main-menu'>m</div><p>body</p>"]
    df = spark.createDataFrame([(i, f"http://h{i}.example.com/x", p, 7) for i, p in enumerate(pages)], "page_id long, url string, html string, text int")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(df).collect()}
    assert got[0][0] == "Head & line First bold, text more. Second <tag>"
    assert [got[i][0] for i in range(1, 7)] == ["", "", "open", "plain & simple", "x", "body"]
    assert all(n == len(t) for t, n in got.values())
    assert html_text.main_text(df.limit(0)).count() == 0


def test_style_tree_removes_what_a_site_repeats(spark):
    page = "<body><div class='box'>Subscribe now and save</div><div class='story'>Story number {0} about {0}.</div></body>"
    rows = [(i, f"https://site.example.com/{i}", page.format(i * i)) for i in range(20)]
    rows += [(100 + i, f"https://other.example.org/{i}", page.format(i)) for i in range(2)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story number 9 about 9."
    assert got[100] == "Subscribe now and save Story number 0 about 0."  # too few pages to tell


# -- near duplicates -------------------------------------------------------------------------------


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute(texts, ids, k, percent):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups: dict = {}
    for i in range(len(texts)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: (len(sets[i]), min(groups[find(i)])) for i in range(len(texts))}


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, k, percent):
    import random

    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = list(TEXTS)
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy[: len(copy) - rng.choice([0, 0, 1, 8])]))
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 6, 30]))) for _ in range(80)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = jaccard_join.jaccard_components(frame(spark, texts, ids), words=k, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts, ids, k, percent)


def test_jaccard_odd_ids(spark):
    rows = jaccard_join.jaccard_components(frame(spark, ["a b c d e"] * 3 + [None], [4, 4, None, None])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (0, 4), (4, 4), (4, 4)]
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


# -- fingerprints ----------------------------------------------------------------------------------


def test_fingerprints(spark):
    texts = [t if t is None else t[:400] for t in TEXTS] + ["Alpha beta. Gamma delta!\nNew line\n" * 9]
    rows = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(frame(spark, texts)).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        new = fingerprints.edit(t, plain[(i + 1) % len(plain)])
        r = rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.fingerprint(t) and r["edited_fingerprint"] == fingerprints.fingerprint(new)
        assert 0 <= r["near_edited"] <= 1 and (r["near_edited"] == 1) == (t == new)
    assert len({r["fingerprint"] for r in rows.values()}) == len(set(plain))
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    one = fingerprints.edited_fingerprints(frame(spark, ["abcd efgh"])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_edits_are_located():
    text = "".join(f"Paragraph {i} says something of its own. And goes on.\n" for i in range(60))
    edited = text.replace("Paragraph 30 says", "Paragraph thirty says")
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(edited)
    assert 0.95 < fingerprints.likeness(a, b) < 1 and len(fingerprints.changed_leaves(a, b)) == 1


@pytest.mark.parametrize("text", TEXTS[1:])
def test_leaves_cover_the_text(text):
    assert "".join(x for p in text.splitlines(keepends=True) for x in fingerprints.leaves(p)) == text


# -- toxicity --------------------------------------------------------------------------------------


def test_toxicity(spark):
    import random

    rng = random.Random(2)
    parts = ["tha", "ing", "ou", "er", "ble", "re", "an", "ti"]

    def text(bad):
        words = ["".join(rng.choice(parts) for _ in range(rng.choice([1, 2, 3]))) for _ in range(rng.randrange(40, 120))]
        if bad:
            for i in range(0, len(words), 12):
                words[i] = rng.choice(["wretched", "vermin", "loathsome"])
        return " ".join(words)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i < 200] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    right = sum(got[i] == t for i, _, t in rows if i >= 200)
    assert right >= 95
    odd = toxicity.score(frame(spark), model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in odd)
    assert all(r["score"] == 0 for r in toxicity.score(frame(spark), None).collect())
    assert toxicity.train(docs, labels.limit(0)) is None
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, p in got.items() if not p}


def test_toxicity_of_a_rarer_language_and_of_inflected_words():
    import random

    rng = random.Random(5)
    parts = {"a": ["tha", "ing", "ou", "er", "ble", "re"], "b": ["lich", "ung", "ei", "sch", "zu", "ver"]}

    def text(bad, tongue):
        words = ["".join(rng.choice(parts[tongue]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(rng.randrange(60, 120))]
        if bad:
            for i in range(0, len(words), 12):
                # the rarer language never repeats a word but for its beginning
                words[i] = "wretched" if tongue == "a" else "grausk" + "".join(rng.choice(parts["b"]) for _ in range(3))
        return " ".join(words)

    rows = [(int(i % 4 == 0), "b" if i % 20 < 5 else "a") for i in range(400)]
    texts = [(bad, text(bad, tongue), tongue) for bad, tongue in rows]
    model = toxicity.Model([t[:2] for t in texts[:240]])
    held = texts[240:]
    predicted = model.scores([t for _, t, _ in held]) >= 0.5
    for tongue in "ab":
        hits = [bool(p) for p, (bad, _, of) in zip(predicted, held) if bad and of == tongue]
        assert hits and sum(hits) >= 0.9 * len(hits), tongue
    assert sum(bool(p) for p, (bad, _, _) in zip(predicted, held) if not bad) <= 2


def test_pii_beside_other_numbers(spark):
    texts = [
        "call +1 (826) 555-4081 190.137.223.204 now",
        "call +1 (826) 555-4081 now",
        "at 190.137.223.204 now",
        "call +1 (826) 555-4081 2024 now",
        "pay 4111 1111 1111 1111 12/26",
        "pay 4111 1111 1111 1111 123",
        "pay 4111 1111 1111 1111 now",
        "no 1234 4111 1111 1111 1111 of them",
        "to BE68 5390 0754 7034 BIC XX",
        "to BE68 5390 0754 7034 EUR 12",
        "to BE68 5390 0754 7034.",
    ]
    out = [r["text"] for r in pii.pseudonymise(frame(spark, texts), "k").orderBy("doc_id").collect()]
    phone, ip, card, iban = out[1][5:-4], out[2][3:-4], out[6][4:-4], out[10][3:-1]
    assert phone != "+1 (826) 555-4081" and ip != "190.137.223.204" and card != "4111 1111 1111 1111" and iban != "BE68 5390 0754 7034"
    assert out[0] == f"call {phone} {ip} now" and out[3] == f"call {phone} 2024 now"
    assert out[4] == f"pay {card} 12/26" and out[5] == f"pay {card} 123" and out[7] == f"no 1234 {card} of them"
    assert out[8] == f"to {iban} BIC XX" and out[9] == f"to {iban} EUR 12"


def test_pii_phones_in_short_groups(spark):
    numbers = ["+49 30 12 34 56 78", "+49 (30) 12 34 56 78", "+33 6 12 34 56 78", "+61 2 9374 4000"]
    out = [r["text"] for r in pii.pseudonymise(frame(spark, [*numbers, *[f"{n} and 123" for n in numbers]]), "k").orderBy("doc_id").collect()]
    for n, alone, beside in zip(numbers, out[:4], out[4:]):
        assert alone != n and re.sub("[0-9]", "0", alone) == re.sub("[0-9]", "0", n) and beside == f"{alone} and 123"


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='page has-sidebar'><div class='no-sidebar'><article><p>The story.</p></article></div></div>",
        "<body>Top<div class='container menu-open'><main><p>The story.</p></main><div class=sidebar><article>Teaser</article></div></div>",
        "<body><form action=x><article><p>The story.</p><div class=comments>First!</div></article></form>",
        "<body><div class='layout search-enabled'><p>The story.</p></div><div class=menu>Home</div>",
    ],
)
def test_a_wrapper_named_after_noise_keeps_its_article(page):
    assert [b[0] for b in html_text.blocks(page)] == ["The story."]


def test_style_tree_counts_pages_and_not_blocks_or_copies(spark):
    table = "<body><table>" + "".join(f"<tr><td>{'abc'[i % 3]} cell</td></tr>" for i in range(30)) + "</table></body>"
    copy = "<body>" + "".join(f"<div>Part {i} of a story that stands on many pages.</div>" for i in range(10)) + "</body>"
    rows = [(0, "https://one.example.com/", table)]
    rows += [(1 + i, f"https://copies.example.com/{i}", copy) for i in range(200)]
    rows += [(300 + i, f"https://copies.example.com/x{i}", f"<body><div>Another story, number {i}.</div></body>") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].count("cell") == 30
    assert all(got[i].startswith("Part 0 of a story") and "Part 9" in got[i] for i in range(1, 201))
    assert got[305] == "Another story, number 5."


def test_style_tree_judges_articles_too_and_agrees_with_brute_force(spark):
    page = (
        "<body><article><h1>Case {0}</h1><h2>In short</h2><p>Story number {0} about {0}.</p><p class=sign>Our desk in Lyon.</p>"
        "<div class=box><div class=b{0}>Call us</div></div></article><div class=list><p>{0}</p></div></body>"
    )
    dated = "<body><article><p>The same long story on every page.</p><div class=when>Day {0}</div></article></body>"
    rows = [(i, "https://site.example.com/", page.format(i * i)) for i in range(12)]
    rows += [(100 + i, "https://two.example.com/", page.format(i)) for i in range(2)]
    rows += [(200 + i, "https://dated.example.com/", dated.format(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got[3] == "Case 9 In short Story number 9 about 9. Call us"  # the boxes look different on every page
    assert got[101] == "Case 1 In short Story number 1 about 1. Our desk in Lyon. Call us"  # too few pages to tell
    assert got[204] == "The same long story on every page. Day 4"

    parsed = df.selectExpr("page_id id", "url", "url host", "page_id row", "html").mapInArrow(
        html_text.parse, f"id long, url string, host string, row long, {html_text.PARSED}"
    )
    tree = {(r["host"], r["path"]): (r["n"], r["importance"]) for r in html_text.importance(parsed).collect()}
    seen = {}
    for _, url, source in rows:
        found = html_text.blocks(source)
        for path, content, style in html_text.nodes_of(found)[1]:
            seen.setdefault((url, path), {})[tuple(b[0] for b in found)] = (content, style)
    assert tree.keys() == seen.keys()
    for node, pages in seen.items():
        n, entropies = len(pages), []
        for feature in zip(*pages.values()):
            shares = [feature.count(x) / n for x in set(feature)]
            entropies.append(-sum(p * math.log(p) for p in shares) / math.log(n) if n > 1 else 1.0)
        assert tree[node] == (n, pytest.approx(sum(entropies) / 2, abs=1e-9))
    assert tree["https://site.example.com/", "body/article/p.sign/#"] == (12, pytest.approx(0, abs=1e-9))


def test_sentence_piece_keeps_the_words_it_meets(monkeypatch):
    """Words met in every batch are merged once, however many others there are; ids stay those of the library."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(sentence_piece, "WORDS_KEPT", 50)
    bpe = sentence_piece.Bpe(queries.piece_table())
    merged = []
    of = bpe.merge_words
    monkeypatch.setattr(bpe, "merge_words", lambda words: merged.extend(words) or of(words))
    rng = np.random.default_rng(7)
    letters = np.array([*"aabcdeeghinorst", "\u00e9", "\n", "\u4e2d", "\U0001f600", "\u2581"])
    for _ in range(30):
        texts = ["the story of " + " ".join("".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(20)) for _ in range(3)]
        texts += ["", " ", "  the  story ", "of"]
        assert [ids.tolist() for ids in bpe.encode(texts)] == sp.encode(texts)
        assert len(bpe.known) < 150
    assert merged.count(sentence_piece.MARK + "story") == 1
