"""Collocations, fill-in-the-middle and speculative encoding against brute force and the public library."""

import collections
import hashlib
import random
import re

import pytest
from test_edge_rows import ROWS, documents
from tokenizers import Tokenizer

from slipway.llm import collocations as phrases
from slipway.llm import fill_middle, speculative_bpe
from slipway.llm.frames import stored


def plain_collocations(rows, least=10, held=50, top=2000):
    """All phrases counted one by one."""
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").encode().lower().decode()):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    counts[lang, tuple(words[at : at + size])] += 1
    found, longer = [], collections.defaultdict(list)
    for (lang, words), a in counts.items():
        if len(words) == 3 and a >= least:
            longer[lang, words[:2]].append(a)
            longer[lang, words[1:]].append(a)
    for (lang, words), a in counts.items():
        if len(words) == 1 or a < least or any(100 * c >= held * a for c in longer[lang, words]):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, (left, right) = min((1_000_000 * a * a // (l * r), k, (l, r)) for k, (l, r) in enumerate(cuts))
        found.append((lang, score, a, " ".join(words), left, right))
    ranked = []
    for lang in totals:
        own = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))
        ranked += [(lang, rank, phrase, a, l, r, totals[lang], score) for rank, (_, score, a, phrase, l, r) in enumerate(own[:top], 1)]
    return sorted(ranked)


def found_collocations(docs, **given):
    return sorted(tuple(row) for row in phrases.collocations(docs, **given).collect())


def many_texts(chance, count=60):
    """Few words, so that phrases repeat: chains, circles, pieces of one word, odd spaces and characters."""
    words = ["a", "b", "A", "c d e f g h", "x x x x", "the old mill by the stream", "é", "漢字", "p q p q p q", "  ", "\t", ",", ". ", "\n", "\x0b", " ", "z-1"]
    return [" ".join(chance.choices(words, k=chance.randint(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("seed", range(2))
def test_collocations_by_brute_force(spark, seed):
    chance = random.Random(seed)
    rows = [(chance.choice(["en", "de", None, "und"]), text) for text in many_texts(chance)] + [("en", None), (None, "")]
    docs = spark.createDataFrame([(lang, text, "x", "y") for lang, text in rows], "lang string, text string, node string, n string")
    assert found_collocations(docs, least=4, bucket_bits=[26, 16][seed]) == plain_collocations(rows, least=4)
    assert found_collocations(docs, least=1, held=80, top=7) == plain_collocations(rows, least=1, held=80, top=7)


def test_collocations_of_whole_documents(spark, table):
    docs = table("documents").limit(40)
    rows = [(row.lang, row.text) for row in docs.collect()]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found_collocations(docs) == plain_collocations(rows)


def test_stretches_change_nothing(spark, monkeypatch):
    rows = [("en", text) for text in many_texts(random.Random(9), 30)]
    for size in (1, 40, 300):
        monkeypatch.setattr(phrases, "STRETCH", size)
        counted = collections.Counter()
        for _, text in rows:
            parts = [(*part, 0) for part in phrases._stretches(text.encode().lower())]
            for batch in (phrases._counted(phrases._Read([part], phrases.pa.array(["en"])), None) for part in parts):
                for row in batch.to_pylist():
                    counted[row["node"], row["last"]] += row["n"]
        plain = collections.Counter()
        for _, text in rows:
            for piece in re.split("[.,;:!?\n-\r]", text.encode().lower().decode()):
                words = re.findall("[^ \t]+", piece)
                for at in range(len(words)):
                    plain[" ".join(words[at : at + 2]), words[at + 2] if at + 2 < len(words) else None] += 1
        assert counted == plain


def test_unary_paths(spark):
    """A chain with a branch, a circle, and a word that follows itself."""
    chain = "s t u v w x y z"
    texts = [chain, "u v w q", "l m n l m n l m", "k k k k"]
    edges = {(w[i], w[i + 1], w[i + 2]) for text in texts for w in [text.split()] for i in range(len(w) - 2)}
    table = stored(spark.createDataFrame([("en", f"{a} {b}", c, 1) for a, b, c in edges], "lang string, node string, last string, n long"), "edges")
    found = {f"{row.node} {row.last}": (row.head, row.place) for row in phrases.unary_paths(table).collect()}
    assert [found[x] for x in ("s t u", "t u v", "u v w")] == [("s t u", 0), ("s t u", 1), ("s t u", 2)]
    assert [found[x] for x in ("v w x", "w x y", "x y z")] == [("v w x", 0), ("v w x", 1), ("v w x", 2)]
    assert found["v w q"] == ("v w q", 0) and found["k k k"] == ("k k k", 0)
    assert all(found[x] == (x, 0) for x in ("l m n", "m n l", "n l m"))


def test_long_paths_in_rows(spark, monkeypatch):
    """Paths of several rows, and counts beyond 32 bits squared."""
    monkeypatch.setattr(phrases, "PATH", 4)
    rows = [("en", " ".join(f"w{n}" for n in range(50)))] * 12 + [("en", "w7 w8 w9")] * 5
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found_collocations(docs) == plain_collocations(rows)


def test_scores_are_exact(spark):
    big = 3_037_000_500_123
    row = spark.createDataFrame([(big, big + 1, big + 2)], "a long, l long, r long")
    assert row.selectExpr(phrases._floored("a", "l", "r")).first()[0] == 1_000_000 * big * big // ((big + 1) * (big + 2))


def test_skip_list_ranks():
    chance = random.Random(3)
    token = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
    texts = ["", " ", "a", " a", "a ", "é 漢字\n\nx", *("".join(chance.choices("aé漢 \t\n\U0001f600", k=chance.randint(0, 400))) for _ in range(200))]
    for text in texts:
        tokens, index = token.findall(text), fill_middle.SkipList(text)
        assert index.size == len(tokens)
        for rank in range(len(tokens) + 1):
            assert index.code_points(rank) == len("".join(tokens[:rank]))


def test_forms_and_restoring(spark):
    token = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
    texts = ["one two three", "a <P> b", "<S>", "<M>", " < <P <S< M> >", "<", "é\n漢字 \t x ", None, "", "<<P", "S> x", "many words " * 5000]
    rows = [(number, text) for number, text in enumerate(texts * 12)] + [(None, "no id at all"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(*row, "x", "y") for row in rows], "doc_id long, text string, form string, output string")
    found = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored("form", "output")).collect()
    forms = collections.Counter(row.form for row in found)
    assert forms.keys() == {"plain", "psm", "spm"} and len(found) == len(rows)
    texts = collections.defaultdict(list)
    for number, text in rows:
        texts[number].append(text or "")
    for row in found:
        text = row.back
        assert text in texts[row.id]
        drawn = hashlib.sha256(f"42:{'' if row.id is None else row.id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[8 * k : 8 * k + 8], 16) for k in range(4))
        tokens = token.findall(text)
        if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
            assert (row.form, row.output, row.prefix_chars, row.middle_chars) == ("plain", text, None, None)
            continue
        low, high = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
        a, b, c = ("".join(part) for part in (tokens[:low], tokens[low:high], tokens[high:]))
        form = "spm" if h4 % 100 < 80 else "psm"
        assert (row.form, row.prefix_chars, row.middle_chars, row.n) == (form, len(a), len(b), len(tokens))
        assert row.output == (f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(speculative_bpe.MODEL)


@pytest.fixture(scope="module")
def codec():
    return speculative_bpe.Codec(speculative_bpe.MODEL)


def agrees(codec, library, texts):
    for text, (ids, decoded) in zip(texts, codec.round_trips(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == b"".join(b"%d," % number for number in expected), text[:80]
        assert decoded.decode("utf-8", "replace") == library.decode(expected, skip_special_tokens=False)


def test_encoding_equals_the_library(codec, library):
    chance = random.Random(1)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "\n", "'s", "'", "1", "é", "漢", "\x85", "​", "　", "!", "<|endoftext|>", "<|endof", "aaaa", "ing", "\x1c", "\U000105c0", "՘", "꟎", "\t", "\U0001f600", "the", " the", "\x00"]
    agrees(codec, library, ["".join(chance.choices(parts, k=chance.randint(0, 25))) for _ in range(20_000)])
    agrees(codec, library, ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=60_000)), "a" * 5000, "ACGT" * 3000, "ha" * 999, "漢字" * 3000, " " * 3000])


def test_every_character_is_of_the_library_s_kind(codec, library):
    agrees(codec, library, ["".join(f"a{chr(c)}1" for c in range(start, min(start + 4096, 0x110000)) if not 0xD800 <= c < 0xE000) for start in range(0, 0x110000, 4096)])


def test_encoding_of_whole_documents(spark, table, library):
    docs = table("documents")
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in speculative_bpe.round_trip(docs).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    back = {row.id: row.text for row in speculative_bpe.decode(speculative_bpe.encode(docs)).collect()}
    assert back == texts


def test_pairs_stay_apart_as_merging_says(codec):
    """``compatible`` against merging the two tokens' bytes, and guesses against a search for the longest token."""
    encoder, chance = codec.encoder, random.Random(4)
    numbers = sorted(encoder.ids.values())
    a, b = (speculative_bpe.np.array(chance.choices(numbers, k=4000)) for _ in range(2))
    expected = [encoder.merged(encoder.model.tokens[x] + encoder.model.tokens[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert encoder.compatible(a, b).tolist() == expected and 0 < sum(expected) < 4000
    words = ["".join(chance.choices("abcdehorst ingé", k=chance.randint(1, 30))).encode() for _ in range(300)]
    tokens, starts = encoder.guesses(words)
    for at, word in enumerate(words):
        plain, place = [], 0
        while place < len(word):
            end = next(end for end in range(len(word), place, -1) if word[place:end] in encoder.ids)
            plain.append(encoder.ids[word[place:end]])
            place = end
        assert tokens[starts[at] : starts[at + 1]].tolist() == plain
    assert codec.encoder.guessed > codec.encoder.failed > 0


def test_a_small_memory_changes_nothing(library):
    small = speculative_bpe.Codec(speculative_bpe.MODEL)
    small.memory.most = 3
    texts = ["one two three", "three four", "five one", ""]
    for _ in range(2):
        agrees(small, library, texts)


BY_ROW = {"fill": fill_middle.fill_in_middle_digests, "encode": speculative_bpe.round_trip}


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(spark, name):
    found = BY_ROW[name](documents(spark, ROWS)).collect()
    assert sorted((row.doc_id for row in found), key=repr) == sorted((row[0] for row in ROWS), key=repr)
    assert BY_ROW[name](documents(spark, [])).count() == 0


def test_collocations_of_edge_rows(spark):
    assert found_collocations(documents(spark, ROWS)) == plain_collocations([(row[2], row[1]) for row in ROWS])
    assert found_collocations(documents(spark, ROWS), least=2) == plain_collocations([(row[2], row[1]) for row in ROWS], least=2)
    assert phrases.collocations(documents(spark, [])).count() == 0
