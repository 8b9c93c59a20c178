"""Classifiers, secrets, language model, mixing, URLs and the pipeline."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from compare import database, difference, spark_rows, sql_rows
from text_samples import awkward, frame, table
from tidemill.llm import mixing, quality, secrets, suffixtree, toxicity, urls
from tidemill.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def test_every_query_is_sql_or_tested():
    assert set(QUERIES) == {f"op{n}_{name}" for n, name in enumerate(
        ("subspaces", "quality", "toxicity", "substrings", "secrets", "minhash", "decontaminate",
         "mixing", "suffix_tree", "url_filter", "byte_bpe", "hard_negatives", "spellings"), 1)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got[1]
    assert difference(got, sql_rows(database(FOLDER), ORACLE[name])) is None


# Mixing

def mixed_by_sql(rows, limit):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sql_rows(con, mixing.mixing_sql(limit))


@pytest.mark.parametrize("limit", [1.0, 1.3, 2.5, 50.0])
def test_mixing(spark, limit):
    docs = frame(spark, awkward())
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = spark_rows(mixing.mixing_plan(docs, max_repeats=limit))
    assert difference(got, mixed_by_sql(rows, limit)) is None


def test_mixing_meets_entropy_and_budget(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 + i % 9), f"s{min(i % 40, 3)}") for i in range(4000)],
        "doc_id long, text string, source string")
    budget = 9000
    plan = mixing.mixing_plan(docs, entropy=1.0, budget=budget).groupBy("source").sum("n_tokens")
    weights = np.array([r[1] for r in plan.collect()], float)
    assert budget - 60 <= weights.sum() <= budget
    weights /= weights.sum()
    assert abs(-(weights * np.log(weights)).sum() - 1.0) < 0.01


def test_mixing_of_nothing(spark):
    assert mixing.mixing_plan(frame(spark, []), max_repeats=2).count() == 0
    assert mixing.mixing_plan(frame(spark, [(1, None), (2, " ")]), max_repeats=2).count() == 0


# URLs

def judged(pages, rules, listed):
    out = []
    for page, url in pages:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = (max(fits)[1:] if fits else (None, None))
        inside = bool(host) and host + re.sub(r"(\.html|/)\Z", "", path) in listed
        out.append((page, host, path, rule, verdict or ("block" if inside else "allow"), inside))
    return out


def test_url_verdicts(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    listed = {"shop.net/a", "b.com/x", "ü.net/é"} | {f"many{i}.net/p" for i in range(3000)}
    pages = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://ORG"), (6, "x://org/"),
             (7, "http://a.b.EXAMPLE.org/es/x?y#z"), (8, "http://example.org/en/123"),
             (9, "http://badexample.org/es/"), (10, "http://com/fr/"), (11, "https://x.com/de/a://b"),
             (12, "http://shop.net/a.html?q"), (13, "http://shop.net/a/"), (14, "http://b.com/x#f"),
             (15, "ftp://ü.net/é"), (None, "http://shop.net/a"), (13, "http://shop.net/a/"),
             (16, "http://x.com/DE/" + "a" * 100_000), (17, "http://many7.net/p"), (18, "http://a?b/c"),
             (19, "http://new\nline.org/a\nb"), (20, "://org/x"), (21, "http://example.org./es/")]
    frame_ = spark.createDataFrame([(*p, "k", "r") for p in pages],
                                   "page_id long, url string, host string, rule string")
    got = urls.url_verdicts(frame_, spark.createDataFrame(rules, "verdict string, host string, path string"),
                            spark.createDataFrame([(u,) for u in listed] * 2 + [(None,)], "url string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(judged(pages, rules, listed), key=str)


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    listed = spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in urls.url_verdicts(pages, none, listed).collect()] == ["allow"]
    assert urls.url_verdicts(pages.limit(0), none, listed).count() == 0


# Secrets

def brute_spans(text):
    """Base spans, found character by character."""
    def runs(ok, start):
        end = start
        while end < len(text) and ok(text[end]):
            end += 1
        return end

    out, i = [], 0
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def assign(at):
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if text[at:at + len(name)].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) == name:
                p = at + len(name)
                p += text[p:p + 1] in ("'", '"')
                p = runs(lambda c: c == " ", p)
                if text[p:p + 1] not in ("=", ":") or not text[p:p + 1]:
                    continue
                p = runs(lambda c: c == " ", p + 1)
                q = p + (text[p:p + 1] in ("'", '"') and bool(text[p:p + 1]))
                end = runs(value.__contains__, q)
                if end > q:
                    return q, end
        return None

    while i < len(text):
        found = assign(i)
        if found:
            if found[1] - found[0] >= 6:
                out.append((i, 0, found[1]))
            i = found[1]
        else:
            i += 1
    i = 0
    upper = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    while i < len(text):
        if text[i:i + 4] == "AKIA" and runs(upper.__contains__, i + 4) > i + 4:
            end = runs(upper.__contains__, i + 4)
            if end - i >= 20:
                out.append((i, 1, end))
            i = end
        else:
            i += 1
    i = 0
    while i < len(text):
        end = runs(set("0123456789abcdef").__contains__, i)
        if end - i >= 24:
            out.append((i, 2, end))
        i = max(end, i + 1)
    return sorted(out)


SECRET_TEXTS = [
    None, "", "password=abcdef", "password=abcde token: 'abcdefgh'", "PassWord\" : \"x+/=._-y\"",
    "pa\u017f\u017fword=abcdefgh", "to\u212aen=abcdefgh", "api_key=token=abcdef apikey  =  zzzzzzzz",
    "AKIA" + "A" * 16, "AKIA" + "A" * 15, "xAKIAAKIA" + "B" * 20 + "z", "0" * 23, "a" * 24 + "G" + "b" * 30,
    "é token=çabc token=abcdef\u00e9", "secret\t=abcdefg", "secret=\nabcdefg", "password password=123456",
    "secret: " + "f" * 40 + " 🙂 " + "1" * 24, "token==abcdefg", "x" * 50_000 + " passwd=q1w2e3r4",
    "token = \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\""]


@pytest.mark.parametrize("text", SECRET_TEXTS)
def test_base_spans(text):
    assert secrets.base_spans(text or "") == brute_spans(text or "")


@pytest.mark.parametrize(("text", "want"), [
    ('key1 = "Zx81kQp02Lm"\nclient_secret = key1', ["Zx81kQp02Lm"]),
    ('a = "Zx81kQp02Lm"; b = a; cfg.db.password = b', ["Zx81kQp02Lm"]),
    ("export DB_PASSWORD='Zx81 kQp02 Lm'", ["Zx81 kQp02 Lm"]),
    ('dbPassword: "abc12" + "xyz98q"', ['abc12" + "xyz98q']),
    ('{"accessKey": "Zx81kQp02Lm"}', ["Zx81kQp02Lm"]),
    ("password = changeme123", []), ('title = "Zx81kQp02Lm"', []), ("password = short", []),
    ('if password == "Zx81kQp02Lm":', []), ("auth_token=${TOKEN}", []),
    ("The secret: be kind and write well", []), ("=" * 50_000, []), ('x = "' + "\\" * 50_000, []),
    ("private_key = load_key(path)", []), ("client_pwd = settings.DB_PWD_VALUE", []),
    ("private_key = self.signing_key2", []), ("secret_key=default_secret_value", []),
    ("connect(secret_key=default_secret_value, user=u)", []), ("pwd = keys[index12]", []),
    ('client_pwd = K\nK = "Zx81kQp02Lm"', ["Zx81kQp02Lm"]),
    ('K = "Zx81kQp02Lm"\nK = load()\nclient_pwd = K', []),
    ('a = b\nb = a\nprivate_key = a', []),
    ('private_key = """Zx81\nkQp02Lm"""', ["Zx81\nkQp02Lm"]),
    ("private_key = '''Zx81kQp02Lm'''", ["Zx81kQp02Lm"]),
    ("const clientPwd = `Zx81kQp02Lm`;", ["Zx81kQp02Lm"]),
    ('client_pwd = "Zx81k" "Qp02Lm"', ['Zx81k" "Qp02Lm']),
    ('client_pwd = ("Zx81k"\n    "Qp02Lm")', ['Zx81k"\n    "Qp02Lm']),
    ('client_pwd: str = "Zx81kQp02Lm"', ["Zx81kQp02Lm"]),
    ('a:\n  private_key: |\n    Zx81kQp02Lm\n    Qp02LmZx81\n  other: x', ["Zx81kQp02Lm\n    Qp02LmZx81"]),
    ("private_key: |", []), ("private_key: >\nnext: 1", []),
    ("<db:password enc='n'> Zx81kQp02Lm </db:password>", ["Zx81kQp02Lm"]),
    ("<password></password><title>Zx81kQp02Lm</title>", []),
    ('client_pwd = "Zxxxx81kQp02Lm"', ["Zxxxx81kQp02Lm"]),
    ('secret_url = "postgres://adm:Zx81kQp02Lm@db.example.org/x"', ["postgres://adm:Zx81kQp02Lm@db.example.org/x"]),
    ('client_pwd = "your_password_here"', []), ('client_pwd = "xxxx-xxxx-xxxx"', []), ('client_pwd = "********"', []),
    ("Server=db;Pwd=Zx81kQp02Lm;", ["Zx81kQp02Lm"]), ("pwd=correct-horse-battery", ["correct-horse-battery"]),
    ("call(pwd=total-offset-width)", []), ("client_pwd=hunter2222", ["hunter2222"]), ('pwd = ""', []), ('pwd = """"""', []), ("pwd = ''''''", [])])
def test_literals(text, want):
    assert [text[a:b] for a, b in secrets.literals(text)] == want


def test_secret_spans(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(SECRET_TEXTS)] + [(1, SECRET_TEXTS[2])] * 2
    got = secrets.secret_spans(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((d, *[sum(s[1] == k for s in brute_spans(t or "")) for k in range(3)], hashlib.sha256(
        secrets.joined(brute_spans(t or "")).encode()).hexdigest()) for d, t in rows), key=str)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    assert secrets.secret_spans(frame(spark, [])).count() == 0


def test_redacted(spark):
    docs = frame(spark, [(1, "a password=abcdefgh b"), (2, "clean"), (3, None)])
    got = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert got[1].text == "a [SECRET] b" and got[1].n_chars == 12
    assert got[2].text == "clean" and got[3].text is None
    assert secrets.redacted(docs).columns == docs.columns


# Language model

def test_suffix_tree_counts(spark):
    rows = awkward()
    got = sorted(map(tuple, suffixtree.scored(frame(spark, rows)).collect()), key=str)
    tokens = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    counts = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((d, h, len(ws), sum(counts[w] > 0 for w in ws), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
                   for (d, ws), h in zip(tokens, held)), key=str)
    assert [r[:5] for r in sorted(got, key=lambda r: str(r[:4]))] == [
        r[:5] for r in sorted(want, key=lambda r: str(r[:4]))]
    assert np.allclose(sorted(r[5] for r in got), sorted(r[5] for r in want), rtol=1e-9)


class PlainTree:
    """The tree in dictionaries of words, all contexts tried one after the other."""

    def __init__(self, texts):
        self.texts = [(t or "").encode().lower().split() + [b""] for t in texts]
        self.counts = Counter(w for ws in self.texts for w in ws)
        self.mass = sum(self.counts.values()) + len(self.counts) + 1
        self.left, self.known, self.depth = {}, {}, 0
        while self.depth < suffixtree.DEPTH and self.grown(self.depth + 1):
            self.depth += 1

    def grown(self, length):
        follow = {}
        for ws in self.texts:
            for i in range(length, len(ws)):
                context = tuple(ws[i - length:i])
                if length == 1 or context[1:] in self.left:
                    follow.setdefault(context, Counter())[ws[i]] += 1
        for context, nexts in follow.items():
            total, seen = sum(nexts.values()), {w: n for w, n in nexts.items() if n >= 2}
            base = {w: self.p(context[1:], w) for w in seen}
            rest, told = total - sum(seen.values()), sum(
                n * math.log(n / total / base[w]) for w, n in seen.items())
            if rest:
                told += rest * math.log(rest / total / (1 - sum(base.values())))
            if total >= 10 and seen and 2 * told > len(seen) + 5 * math.sqrt(2 * len(seen)):
                self.left[context] = (rest + 20) / (total + 20)
                self.known[context] = {w: n / (total + 20) for w, n in seen.items()}
        return any(len(c) == length for c in self.left)

    def p(self, context, word):
        """By the longest retained suffix of the context."""
        while context and context not in self.left:
            context = context[1:]
        if not context:
            return (self.counts[word] + 1) / self.mass
        return self.known[context].get(word, 0) + self.left[context] * self.p(context[1:], word)

    def score(self, text):
        ws = (text or "").encode().lower().split() + [b""]
        out = 0.0
        for i, w in enumerate(ws):
            length = 0  # suffixes grow while they are retained
            while length < i and tuple(ws[i - length - 1:i]) in self.left:
                length += 1
            out += math.log10(self.p(tuple(ws[i - length:i]), w))
        return out


def phrases():
    rng = np.random.default_rng(4)
    noise = [" ".join(f"n{x}" for x in rng.zipf(1.4, 40) % 3000) for _ in range(1500)]
    ends = ("in the very red barn", "in the very blue house", "of the very green tree")
    return noise + [f"{t} {ends[i % 3]}" for i, t in enumerate(noise[:60])] + ["In The Very Red x"]


@pytest.mark.parametrize("bounds", [None, (0, 0), (30, 100)], ids=["head", "rest", "both"])
def test_suffix_tree_is_that_of_dictionaries(spark, monkeypatch, bounds):
    """Whatever share of it is sent to the tasks, and in however many parts it is counted."""
    if bounds:
        monkeypatch.setattr(suffixtree, "HEAD_WORDS", bounds[0])
        monkeypatch.setattr(suffixtree, "HEAD_TERMS", bounds[1])
        monkeypatch.setattr(suffixtree, "PART", 1000)
        monkeypatch.setattr(suffixtree, "COUNTED", 5000)
    rows = [(i, t) for i, t in enumerate(phrases())] + [(None, None), (7000, "in the very red roof")]
    plain = PlainTree([t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2])
    assert plain.depth >= 3 and len(plain.left) > 30
    got = sorted(((r.doc_id, r.score) for r in suffixtree.scored(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()), key=str)
    want = sorted(((i, plain.score(t)) for i, t in rows), key=str)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-6)


def test_suffix_tree_is_a_distribution():
    plain = PlainTree(phrases())
    for context in [(), *list(plain.left)[:40]]:
        total = sum(plain.p(context, w) for w in plain.counts)
        unknown = math.prod(plain.left[context[i:]] for i in range(len(context))) / plain.mass
        assert abs(total + unknown - 1) < 1e-9


def test_suffix_tree_helps(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = suffixtree.scored(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_most_frequent_is_bounded(spark):
    rows = spark.createDataFrame([(n,) for n in range(1, 400)], "n long")
    for most in (0, 10, 399, 1000):
        kept = [r.n for r in rows.where(suffixtree._most_frequent(rows, most)).collect()]
        assert len(kept) <= most and (most < 399 or len(kept) == 399)
        assert sorted(kept) == list(range(400 - len(kept), 400))


def test_suffix_tree_of_nothing(spark):
    assert suffixtree.scored(frame(spark, [])).count() == 0
    got = suffixtree.scored(frame(spark, [(1, None), (2, "")])).collect()
    assert {r.n_tokens for r in got} == {1}


# Classifiers

def scores(spark, name, label):
    got = {r.doc_id: r for r in QUERIES[name](spark, MEDIUM).collect()}
    rows = [(got[d], y) for d, y in table(MEDIUM, "labels", f"doc_id, {label}") if got[d].held_out]
    good = [r.score for r, y in rows if y]
    bad = [r.score for r, y in rows if not y]
    area = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    return got, area


@pytest.mark.parametrize(("name", "label", "parts", "held", "least"),
                         [("op2_quality", "quality", 4, 2, 0.95), ("op3_toxicity", "toxic", 5, 0, 0.85)])
def test_held_out_accuracy(spark, name, label, parts, held, least):
    got, area = scores(spark, name, label)
    assert area > least
    assert len(got) == len(table(MEDIUM, "documents"))
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % parts == held)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= (0.7 if label == "quality" else 0.5))


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("given", [[], [(1, 1, 0)], [(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None)]])
def test_classifiers_on_awkward_tables(spark, given):
    docs, rows = frame(spark, awkward()), labels(spark, given)
    machine = quality.quality_machine(docs, rows)
    assert quality.quality_scores(docs, machine).where("score between 0 and 1").count() == docs.count()
    assert quality.quality_scores(docs.drop("n_chars"), machine).count() == docs.count()
    assert quality.quality_scores(docs.limit(0), machine).count() == 0
    lexicon = toxicity.toxicity_lexicon(docs, rows)
    assert toxicity.toxicity_scores(docs, lexicon).where("score between 0 and 1").count() == docs.count()
    assert toxicity.toxicity_scores(docs.limit(0), lexicon).count() == 0
    if not given:
        assert quality.good_documents(docs, machine).count() == docs.count()
        assert toxicity.toxicity_scores(docs, lexicon).where("predicted = 1").count() == 0


def test_factorisation_identity():
    random = np.random.default_rng(2)
    size = quality.WORD_SLOTS + quality.STATISTICS
    machine = quality.Machine(0.3, random.normal(size=size), random.normal(size=(size, 8)))
    slots = np.sort(random.choice(size, 30, replace=False))
    values = random.normal(size=30)
    pairs = sum(values[i] * values[j] * (machine.factors[slots[i]] @ machine.factors[slots[j]])
                for i in range(30) for j in range(i))
    want = 0.3 + machine.weights[slots] @ values + pairs
    assert abs(machine.raw(quality.Vector(slots, values)) - want) < 1e-9


def test_lexicon_counts_texts_that_are_no_copies(spark):
    common = min((f"c{i}" for i in range(5000)), key=lambda w: xxhash.xxh3_64_intdigest(w, 0))
    rows = [(i, f"{common} w{i} x{i} {'blargh' if i % 3 == 0 else 'kindly'}") for i in range(60)]
    rows += [(i, f"{common} copied wretch") for i in range(60, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    given = labels(spark, [(i, 1, int("blargh" in t or "wretch" in t)) for i, t in rows])
    weights = toxicity.toxicity_lexicon(docs, given).weights
    assert "=blargh" in weights and "=wretch" not in weights


@pytest.fixture(scope="module")
def characters(spark):
    prose = "you are an idiot and a moron . this is stupid trash , what a loser and a clown ! pathetic "
    docs = spark.createDataFrame([(i, prose * 20) for i in range(5)], "doc_id long, text string")
    return toxicity.language_model(toxicity.trigram_counts(docs))


@pytest.mark.parametrize(("written", "plain"), [
    ("1d10t", "idiot"), ("!d!ot", "idiot"), ("idiot!!!", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"),
    ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("l-o-s-e-r", "loser"), ("cl*wn", "clown"),
    ("p@thet1c", "pathetic"), ("moron", "moron"), ("2024", "2024"), ("(idiot)", "idiot"), ("", ""), ("!!!", ""),
    ("iiddiioott", "idiot"), ("idi.ot", "idiot"), ("st-upid", "stupid"), ("mo_ron", "moron"), ("m.0-r0n", "moron"),
    ("you-are", "you are"), ("12.5", "12.5"), ("3-4", "3-4")])
def test_restored(characters, written, plain):
    assert toxicity.restored(written, characters) == plain


@pytest.mark.parametrize("token", ["1d10t", "i.d-iot", "aabb!t", "b00k", "l--oser", "cl*n", "id||t", "looooser", "s$s"])
@pytest.mark.parametrize("spaced", [False, True])
def test_decoder_finds_the_best_of_all_paths(characters, token, spaced):
    runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token)]
    choices = []
    for i, (char, length) in enumerate(runs):
        readings = toxicity._readings(char, length, 0 < i < len(runs) - 1, spaced)
        choices.append(readings + [(" " + t, c + toxicity.GAP) for t, c in readings if t and spaced and i])
    best = max(sum(c for _, c in path) + toxicity._likelihood("".join(t for t, _ in path), characters)
               for path in itertools.product(*choices))
    text, score = toxicity.best_path(token, characters, spaced)
    assert abs(score - best) < 1e-9


def test_words_in_pieces(characters):
    known = {f"={w}": 5.0 for w in ("idiot", "stupid", "moron")}
    evidence = toxicity._Evidence(toxicity.Lexicon(characters, known, np.array([1.0, 0.0, 0.0])))
    for text in ("you id iot there", "an i  d  i  o  t", "an\ti\td\ti\no\tt !", "st up id", "a m0 r0n",
                 "idi.ot", "iiddiioott", "stuupid"):
        assert evidence.features(text)[0] == 5.0, text
    for text in ("you are an id card", "it is on us", "st. up id", "the idea I got", "", None, "id  " * 1000):
        assert evidence.features(text)[0] == 0.0, text


def test_tokens_passed_over_have_no_evidence(characters):
    pick = np.random.default_rng(5)
    known = {"=idiot": 5.0, "=aab": 4.0, "stup": 3.0, "mooo": 2.0, "=looser": 2.0}
    evidence = toxicity._Evidence(toxicity.Lexicon(characters, known, np.array([1.0, 0.0, 0.0])))
    tokens = {"".join(np.repeat(list(pick.choice(list("idotsupmaler"), 5)), pick.integers(1, 4, 5))) for _ in range(3000)}
    for word in ("idiot", "aab", "stupid", "moon", "looser"):
        tokens |= {"".join(np.repeat(list(word), pick.integers(1, 4, len(word)))) for _ in range(200)}
    assert sum(evidence[t] > 0 for t in tokens) > 50
    for token in tokens:
        assert evidence[token] == evidence._of(evidence.plain(token)), token


def test_rows_of_repeated_labelled_ids_are_bounded(spark):
    docs = spark.createDataFrame([(1, None)] + [(1, f"text {i}") for i in range(500)] + [(2, "b"), (None, "n")],
                                 "doc_id long, text string")
    given = labels(spark, [(1, 1, 0), (1, 0, 0), (2, 1, 0)])
    rows = quality.labelled(docs, given, "quality", 1, 5, 100).collect()
    assert sorted((r.doc_id, r.text, r.label) for r in rows) == [(1, "text 99", 0), (2, "b", 1)]


def test_spaced(characters):
    assert toxicity.decoded("1d10t", characters, spaced=True).replace(" ", "") == "idiot"
    _, stretches = toxicity._distinct("you i d i o t there, a b c")
    assert stretches == ["i d i o t", "a b c"]


# Pipeline

def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, total = docs.columns, docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        assert docs.count() <= total
        total = docs.count()
    plan = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in plan.select("doc_id").distinct().collect()} <= {
        r.doc_id for r in docs.select("doc_id").collect()}


def test_suffix_tree_rest_filter_grows_with_the_rest():
    # The filter of the terms joined at scoring had a fixed 2^25 bits: 30M terms filled most of it.
    bits = suffixtree._bits(30_000_000, suffixtree.REST_BITS)
    assert bits > 25 and (1 << bits) >= 4 * 30_000_000
    assert suffixtree._bits(1_000) < 25


def test_suffix_tree_leaves_no_tree_and_joins_in_slices(spark, monkeypatch, folder):
    """The rest of the tree was written once more and stayed, and all keys were joined at once."""
    from tidemill.llm import store
    purposes, removed = {}, []
    monkeypatch.setattr(suffixtree, "HEAD_WORDS", 30)
    monkeypatch.setattr(suffixtree, "HEAD_TERMS", 100)
    docs = frame(spark, [(i, t) for i, t in enumerate(phrases())])
    want = {r.doc_id: r.score for r in suffixtree.scored(docs).collect()}

    def place(spark_, purpose):
        purposes.setdefault(purpose, []).append(f"{folder}/{purpose}-{len(purposes.get(purpose, []))}")
        return purposes[purpose][-1]
    monkeypatch.setattr(store, "work_folder", place)
    monkeypatch.setattr(suffixtree, "removed", lambda s, at: removed.append(at) or store.removed(s, at))
    monkeypatch.setattr(suffixtree, "SLICES", 4)
    monkeypatch.setattr(suffixtree, "SLICE", 1000)
    got = {r.doc_id: r.score for r in suffixtree.scored(docs).collect()}
    assert len(purposes["lm-more"]) == 4 and len(purposes["lm-rows"]) == 1
    left = {p for p, places in purposes.items() for at in places if at not in removed}
    assert left == {"lm-rows", "lm-more"}
    assert want.keys() == got.keys()
    assert np.allclose([got[i] for i in want], list(want.values()), rtol=1e-12)
