"""Edge cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import DOCS, ROWS
from treeshred.llm import (bpe, components, exact_dedup, language, licenses, mixing, near_dup, pieces, quality,
                           quality_rules, secrets, token_files)
from treeshred.session import staging_root

@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(4)


@pytest.fixture(scope="module")
def odd(docs):
    """Columns that an operator might use itself."""
    return docs.withColumns({c: F.lit("mine") for c in ("n", "size", "target", "copies", "rid", "name", "level", "score", "kept", "item")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(docs, odd, none):
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[folded(text)].append(doc_id)
    expected = []
    for text, ids in groups.items():
        keep, left = max((i for i in ids if i is not None), default=None), 1
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            expected.append((i, keep, len(ids), kept, sha))
    key = lambda r: tuple(str(x) for x in r)
    for table in (docs, odd):
        assert sorted(map(tuple, exact_dedup.exact_groups(table, block_bytes=64).collect()), key=key) == sorted(expected, key=key)
    assert exact_dedup.exact_groups(none).count() == 0


def test_drop_copies_keeps_columns(docs, odd, none):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted(folded(r.text) for r in left.collect()) == sorted({folded(t) for _, t, *_ in ROWS})
    assert exact_dedup.drop_copies(none).count() == 0


def test_block_names_tell_texts_apart(spark):
    rows = [(i, "ab" * (i % 40) + "c" * (i % 3)) for i in range(400)]
    found = exact_dedup.identities(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=4).collect()
    texts = dict(rows)
    by_name = collections.defaultdict(set)
    for r in found:
        by_name[r.level, r.name].add(texts[r.doc_id])
    assert all(len(x) == 1 for x in by_name.values()) and len(by_name) == len(set(texts.values()))


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1), (None, 1000)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 1, 2, 3, 1 of 1111: c is full at 3, b at 30, and a at 300; null takes the rest.
    assert got == {"a": 300.0, "b": 30.0, "c": 3.0, None: 778.0}


def test_mix(spark, docs, odd, none):
    many = spark.range(4000).select("id", F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.when(
        F.col("id") % 3 == 0, F.lit("w w w")).otherwise(F.expr("repeat('w ', int(1 + id % 50))")).alias("text")).withColumnRenamed("id", "doc_id")
    rows = mixing.with_copies(mixing.measure(many)).collect()
    taken, target = collections.Counter(), {}
    for r in rows:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.mix_size
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 60 for s, t in target.items())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.with_copies(mixing.measure(many.repartition(7))).collect()))
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.where("n <> 'mine'").count() == 0
    assert len(mixing.with_copies(mixing.measure(docs)).collect()) == len(ROWS)
    assert mixing.mix(none).count() == 0


def brute_components(rows, words, percent=80):
    found = [re.findall(r"[^\x20\x09-\x0D]+", folded(t)) for _, t, *_ in rows]
    sets = [{tuple(f[i:i + words]) for i in range(max(1, len(f) - words + 1))} if f else set() for f in found]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    return sorted((str(r[0]), len(sets[i]), str(min((x for x in ids[find(i)] if x is not None), default=None)))
                  for i, r in enumerate(rows))


def near_rows():
    """A large group of near copies of one text, a chain, and texts that share half."""
    rnd = np.random.default_rng(5)
    word = lambda: f"w{rnd.integers(0, 5000)}"
    base = [word() for _ in range(120)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rnd.integers(0, 6)):
            copy[rnd.integers(0, len(copy))] = word()
        rows.append((i, " ".join(copy)))
    chain = [word() for _ in range(150)]
    for i in range(20):
        rows.append((200 + i, " ".join(chain[4 * i:4 * i + 70])))
    for i in range(40):
        rows.append((300 + i, " ".join(base[:60] + [word() for _ in range(60)])))
    return rows


def test_near_duplicates(spark, docs, odd, none):
    for rows, words in ((ROWS, 2), (near_rows(), 2), (near_rows(), 5)):
        table = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_dup.near_duplicates(table, words).collect())
        assert got == brute_components(rows, words)
    assert near_dup.near_duplicates(none).count() == 0
    assert near_dup.drop_near_duplicates(none).count() == 0
    left = near_dup.drop_near_duplicates(odd, 2)
    assert left.columns == odd.columns
    # One of the two sitting cats, one of the two long texts, one of the repeated rows; all else stays.
    assert left.count() == len(ROWS) - 3


def test_one_leader_round_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MAX_LEADER_ROUNDS", 1)
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_dup.near_duplicates(table, 2).collect())
    assert got == brute_components(rows, 2)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (100, 51), (7, 7)] + [(200, i) for i in range(201, 260)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == got[51] == 50 and got[259] == 200 and 0 not in got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.TOKENIZER)


def test_bpe_equals_the_library(docs, odd, none):
    tokenizer = library()
    expected = sorted(((i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in ROWS), key=str)
    got = bpe.encode(odd)
    assert sorted(((r.doc_id, r.ids) for r in got.collect()), key=str) == expected and got.where("NOT restored").count() == 0
    back = sorted(((r.doc_id, r.text) for r in bpe.decode(got).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t, *_ in ROWS), key=str)
    for r, (i, ids) in zip(sorted(bpe.round_trip_digests(docs).collect(), key=lambda r: (str(r.doc_id), r.n_tokens)),
                           sorted(expected, key=lambda x: (str(x[0]), len(x[1])))):
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode(none).count() == 0


def test_pieces_equal_the_library():
    tokenizer, table = library(), bpe.MergeTable(open(bpe.TOKENIZER).read())
    encoder = pieces.PieceEncoder(table.encode_pieces, table.special, pieces.classes(pieces.packed_classes()))
    rnd = np.random.default_rng(3)
    parts = list("ab'sstmdrvel  \n\t \xa0　é1٣!?.<|>\U0001f600漢Ᲊ") + ["<|endoftext|>", "'re", "'ll", " '", "\r\n"]
    texts = ["".join(rnd.choice(parts, rnd.integers(0, 25))) for _ in range(3000)]
    ids, bounds = encoder.ids(texts)
    for k, text in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_files(spark, odd, none):
    folder = f"{staging_root(spark)}/tokens/test"
    files = token_files.write_token_files(odd, folder, length=64)
    rows = token_files.read_token_files(spark, folder, files).orderBy("start").collect()
    tokenizer = library()
    order = [r.doc_id for r in rows]
    assert order == sorted((i for i, *_ in ROWS), key=lambda i: -1 if i is None else i)
    left = collections.Counter((i, zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
                               for i, t, *_ in ROWS)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        left[r.doc_id, r.ids_crc32] -= 1
    assert not any(left.values())
    system, _ = token_files.file_system(folder)
    file = token_files.TokenFile(system, files[0].path)
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 64 and not ids.flags.owndata
    assert token_files.read_token_files(spark, folder, token_files.write_token_files(none, folder + "-none")).count() == 0


SECRETS = [
    "x password=abcdefgh1 y", 'PassWord : "short" token = "0641917ea4e9feb9cda83477b57ac2654884f485"', "api_key:12345678 apikey=1234567",
    "AKIAABCDEFGHIJKL AKIASHORT xAKIA0123456789ABCD", "é" * 5 + "f" * 31 + " " + "0" * 40 + "g", "ſecret=abcdefghij toKen=abcdefghij",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36, "xoxb-123456789012", "Bearer abcdefghijklmnopqrstuvwx", "tokentoken==abcdefgh==", None, "",
]


def test_secrets(spark, odd, none):
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    table = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id long, text string")
    for r in secrets.find_secrets(table).collect():
        text = SECRETS[r.doc_id] or ""
        expected = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
        expected += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        expected += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        assert sorted(tuple(s) for s in r.spans if s.kind in ("assign", "access", "hex")) == sorted(expected), text
    kinds = {s.kind for r in secrets.find_secrets(table).collect() for s in r.spans}
    assert {"private_key", "code_host", "chat", "bearer"} <= kinds
    assert secrets.find_secrets(odd).count() == len(ROWS) and secrets.find_secrets(none).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == frozenset([frozenset(["aki", "kia"])])
    assert secrets.trigram_query("(abc|def)+x?") == frozenset([frozenset(["abc"]), frozenset(["def"])])
    assert secrets.trigram_query("[0-9a-f]{32,}") is None and secrets.trigram_query("ab|cde") is None
    assert secrets.trigram_query("ab(c|d)e") == frozenset([frozenset(["abc", "bce"]), frozenset(["abd", "bde"])])


def test_language(spark, docs, odd, none):
    model = language.LanguageModel({"en": "the cat and the dog are in the house " * 20, "de": "der hund und die katze sind im haus " * 20})
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in language.identify(odd, model).collect()), key=str)
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for _, _, s in got)
    und = [i for i, p, _ in got if p == "und"]
    assert sorted(map(str, und)) == sorted(map(str, [2, 3, None, 4, 8]))
    names, scores = model.predict(["The cat, and the dog", "DER HUND und die Katze", "123", ""])
    assert names == ["en", "de", "und", "und"] and scores[2] == 0 and scores[0] > 0.3
    assert language.identify(none, language.train(none)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.train(none)).collect()} == {"und"}


def test_parse_counts_phrases():
    known = "abracadabra banana"
    model = language.LanguageModel({"x": known})
    text = "bananabracadxyzabra"

    def phrases(t):
        n, at = 0, 0
        while at < len(t):
            size = 1
            while at + size < len(t) and t[at:at + size + 1] in known:
                size += 1
            at, n = at + size, n + 1
        return n

    symbols = language._unpacked(model.symbols)[[ord(c) for c in text]].astype(np.int32)
    grid = np.full((language.BLOCK, 1), model.pad, np.int32)
    grid[:len(symbols), 0] = symbols
    assert model._parse(grid)[0, 0] == phrases(text)


def test_quality_rules(docs, odd, none):
    got = quality_rules.quality_rules(odd)
    key = lambda r: (str(r[0]), r[1:])
    expected = []
    for doc_id, text, *_ in ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = list(zip(words, words[1:], words[2:]))
        times = collections.Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
                         len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)))
    rows = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert got.where("kept AND base_failed").count() == 0 and quality_rules.quality_rules(none).count() == 0


def test_distance(spark):
    def distance(p, q):
        p, q = np.array(p) / sum(p), np.array(q)
        m = (p + q) / 2
        part = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
        return np.sqrt((part(p) + part(q)) / 2)

    ref = [0.5, 0.25, 0.25, 0.0]
    for counts in ([1.0, 2.0, 3.0, 4.0], [10.0, 0.0, 0.0, 0.0], [2.0, 1.0, 1.0, 0.0]):
        row = spark.range(1).select(quality_rules.distance(F.array(*map(F.lit, counts)), ref).alias("d")).first()
        assert row.d == pytest.approx(distance(counts, ref), abs=1e-9)
    assert spark.range(1).select(quality_rules.distance(F.array(F.lit(0.0), F.lit(0.0)), [0.5, 0.5]).alias("d")).first().d is None


def test_quality(spark, docs, odd, none):
    good = " ".join(f"word{i} goes here." if i % 4 == 3 else f"word{i} text" for i in range(60))
    bad = " ".join("BUY!! NOW!!" for _ in range(60)), " ".join("cell | cell |" for _ in range(60)), " ".join(f"x{i}$$$ %%%" for i in range(60))
    rows = [(i, good.replace("word", f"w{i}"), "en", "a") for i in range(90)] + [(100 + i, bad[i % 3].replace("cell", f"c{i}"), "en", "a") for i in range(15)]
    table = spark.createDataFrame(rows + [(200, "short", "en", "a"), (201, None, "en", "a")], DOCS)
    kept = {r.doc_id for r in quality.keep_good(table).collect()}
    assert kept == {*range(90), 200, 201}
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(none).count() == 0


def planted_votes(seed, n=4000):
    """Votes on 15% bad documents: each labeller hits 40 to 90% of them and accuses 1 to 10% of the good ones, and is unsure of as many."""
    rnd, k = np.random.default_rng(seed), len(quality.LABELLERS)
    truth, hit, false = rnd.random(n) < 0.15, rnd.uniform(0.4, 0.9, k), rnd.permutation(np.linspace(0.01, 0.1, k))
    u = rnd.random((n, k))
    votes = np.where(truth[:, None], np.where(rnd.random((n, k)) < hit, quality.BAD, quality.GOOD),
                     np.where(u < false, quality.BAD, np.where(u < 2 * false, quality.ABSTAIN, quality.GOOD)))
    return truth, hit, false, ["".join(map(str, row)) for row in votes]


@pytest.mark.parametrize("seed", range(4))
def test_label_model_finds_hits_and_false_accusations(seed):
    truth, hit, false, votes = planted_votes(seed)
    patterns = collections.Counter(votes)
    model = quality.estimate(list(patterns), list(patterns.values()))
    assert abs(model.prior - truth.mean()) < 0.03
    assert np.abs(model.table[:, 1, quality.BAD] - hit).max() < 0.07
    assert np.abs(model.table[:, 0, quality.BAD] - false).max() < 0.03
    bad = dict(zip(patterns, model.posterior(list(patterns)) < 0.5))
    assert np.mean([bad[v] == t for v, t in zip(votes, truth)]) > 0.98


def test_licenses(spark, odd, none):
    mit = licenses.TEXTS["MIT"].replace("<year> <copyright holders>", "2021 Jane").replace("License", "Licence").upper()
    texts = [mit, "© 2020 me\nALL RIGHTS  reserved", licenses.TEXTS["ISC"] + " x", "some\nReleased under the MIT licence!\nmore", None, "", "  \n(c) 2020 x"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices) for r in licenses.license_scan(table).collect()}
    assert got == {0: ("MIT", []), 1: ("All-Rights-Reserved", ["All-Rights-Reserved"]), 2: (None, []), 3: (None, ["MIT"]), 4: (None, []), 5: (None, []), 6: (None, [])}
    assert licenses.license_scan(odd).count() == len(ROWS) and licenses.license_scan(none).count() == 0
