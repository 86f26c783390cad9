"""Corpus operators against brute force on small tables with nulls, empty and long texts, ties and clashing columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from traitweave.llm import decontaminate, exact_dedup, html_text, labelled, labelled_findings, language_id, line_dedup
from traitweave.llm import near_dedup, quality, secrets_scan, sentencepiece_codec, suffix_dedup
from traitweave.llm.queries import PIECES

SCHEMA = "doc_id long, text string, lang string, key string, k1 string, id string"
WHITE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(n, rng, vocabulary=None):
    return [rng.choice(vocabulary) if vocabulary else "".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    passage = " ".join(words_of(90, rng))
    base = words_of(120, rng)
    out = [None, "", " \n\t", "One", "Two words", "ä" * 30, passage, passage, f"x {passage} y", passage[50:] + " tail " * 3]
    for i in range(12):
        edited = list(base)
        for _ in range(i % 4):
            edited[rng.randrange(len(edited))] = f"new{i}"
        out.append(" ".join(edited))
    out += ["A shared LINE of some length\n" * 2 + f"own line number {i} here\r\n  a shared line of SOME length " for i in range(4)]
    out += ["a" * 900, "ab" * 700, "a" * 900 + "b", "\n".join(words_of(3000, rng)), "no\x00nul " + passage[:420], " ".join(base[:60]) + "."]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "clash", "clash", "clash") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_by_id(df):
    return {r["id"]: r for r in df.collect()}


def brute_spans(texts, length):
    data = {i: (t or "").encode() for i, t in texts}
    seen = collections.Counter(b[s : s + length] for b in data.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        mask = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mask[s : s + length] = b"\x01" * length
        out[i] = (len(b), [m.span() for m in re.finditer(b"\x01+", bytes(mask))], bytes(x for x, y in zip(b, mask) if not y))
    return out


@pytest.mark.parametrize(("length", "max_group"), [(400, 20_000), (40, 20_000), (40, 1)])
def test_repeated_spans(docs, texts, length, max_group):
    got = rows_by_id(suffix_dedup.repeated_spans(docs, length=length, max_group=max_group))
    expected = brute_spans(texts, length)
    assert {i: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for i, r in got.items()} == expected


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (200, 20)).astype(np.uint8)
    sizes = rng.integers(0, 21, 200)
    rows[np.arange(20) >= sizes[:, None]] = 0
    order, common = suffix_dedup.multikey_order(rows, sizes)
    texts = [rows[i, : sizes[i]].tobytes() for i in order]
    padded = [(t.ljust(20, b"\0"), len(t)) for t in texts]
    assert padded == sorted(padded)
    for a, b, c in zip(texts, texts[1:], common[1:], strict=False):
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert same == c


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(docs, texts, collide):
    from pyspark.sql import functions as F

    options = {"hash128": lambda c: F.lit("same")} if collide else {}
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    expected = {
        i: (min(v)[1], len(v), min(v)[1] == i, hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for _, i in v
    }
    assert {i: tuple(r)[1:] for i, r in rows_by_id(exact_dedup.exact_groups(docs, **options)).items()} == expected


def test_decontamination(spark, docs, texts):
    items = [(1, texts[6][1]), (2, "Two WORDS"), (3, None), (None, "one"), (4, " ".join(texts[10][1].split()[:13])), (5, "...")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = collections.defaultdict(set)
    for item, t in items:
        w = find(lower(t or ""))
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])] |= {str(item)} if item is not None else set()
    expected = {}
    for i, t in texts:
        w, hit, found = find(lower(t or "")), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        expected[i] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    got = rows_by_id(decontaminate.find_hits(docs, benchmark))
    assert {i: tuple(r)[1:] for i, r in got.items()} == expected
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, e in expected.items() if not e[3]}
    assert decontaminate.find_hits(docs, benchmark.limit(0)).filter("n_hit > 0").isEmpty()


@pytest.mark.parametrize("bits", [1 << 27, 512])
def test_line_dedup(docs, texts, bits):
    def key(line):
        return lower(line.strip(WHITE))

    holders = collections.defaultdict(set)
    for i, t in texts:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    expected = {}
    for i, t in texts:
        split = (t or "").split("\n")
        kept = [x for x in split if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == i]
        expected[i] = ("\n".join(kept), len(split), len(split) - len(kept))
    got = rows_by_id(line_dedup.dedup_lines(docs, filter_bits=bits))
    assert sum(e[2] for e in expected.values()) > 0
    assert {i: tuple(r)[1:] for i, r in got.items()} == expected
    whole = line_dedup.drop_repeated_lines(docs)
    assert whole.columns == docs.columns
    assert {r["doc_id"]: r["text"] or "" for r in whole.collect()} == {i: e[0] for i, e in expected.items()}


def brute_components(texts, words, percent):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = {tuple(w[s : s + words]) for s in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize(("words", "percent", "small", "block"), [(3, 85, 64, 256), (5, 80, 2, 4)])
def test_near_groups(docs, texts, words, percent, small, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    expected = brute_components(texts, words, percent)
    got = rows_by_id(near_dedup.near_groups(docs, words=words, percent=percent))
    assert {i: tuple(r)[1:] for i, r in got.items()} == expected
    kept = near_dedup.drop_near_copies(docs, words=words, percent=percent)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, e in expected.items() if e[2]}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64)
    a, b = hashes[:2400], hashes[600:]
    union = np.maximum(near_dedup.set_sketch(a), near_dedup.set_sketch(b))
    assert (union == near_dedup.set_sketch(hashes)).all()
    one = near_dedup.likeliest(near_dedup.set_sketch(a)[None], near_dedup.set_sketch(b)[None], np.array([2400]), np.array([2400]))
    assert abs(one[0] - 0.6) < 0.15


def test_rows_without_ids_repeated_rows_and_empty_tables(spark, docs, nothing):
    rows = [(None, "same text over and over " * 30, *"abcd")] * 2 + [(7, None, *"abcd"), (7, "other", *"abcd")]
    odd = spark.createDataFrame(rows, SCHEMA)
    pieces = sentencepiece_codec.Pieces.load(PIECES)
    forest = secrets_scan.fit([])
    model = language_id.fit([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 12)
    good = quality.fit([("plain words here", 1), ("!!! ### $$$", 0)] * 12)
    runs = [
        lambda d: suffix_dedup.repeated_spans(d),
        lambda d: exact_dedup.exact_groups(d),
        lambda d: decontaminate.find_hits(d, d, item_col="doc_id"),
        lambda d: line_dedup.dedup_lines(d),
        lambda d: near_dedup.near_groups(d),
        lambda d: language_id.predict(d, model),
        lambda d: quality.score(d, good),
        lambda d: quality.filter_quality(d, good, least=0.0),
        lambda d: sentencepiece_codec.encode(d, pieces),
        lambda d: secrets_scan.scan(d, forest),
        lambda d: html_text.extract(d, "doc_id", "lang", "text"),
        lambda d: decontaminate.clean(d, d.limit(0), item_col="doc_id"),
    ]
    for run in runs:
        assert run(odd).count() == 4
        assert run(nothing).count() == 0
    copies = [r for r in suffix_dedup.repeated_spans(odd).collect() if r["id"] is None]
    assert [len(r["kept"]) for r in copies] == [0, 0]


def test_sentencepiece_codec(spark):
    pieces = sentencepiece_codec.Pieces.load(PIECES)
    encoder = sentencepiece_codec.Encoder(pieces)
    number = {t: i for i, t in enumerate(pieces.texts) if pieces.kinds[i] == "n"}
    rng = random.Random(2)
    samples = ["the", "of the land", "internationalisation", "été", "x" * 70, "ab" * 60] + ["".join(rng.choices("aehinorst ,.é", k=25)) for _ in range(60)]
    for text in samples:
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e18] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(max(0, end - 16), end):
                if (i := number.get(marked[start:end])) is not None:
                    best[end] = max(best[end], best[start] + pieces.scores[i])
        ids = np.frombuffer(encoder([text])[0], "<i4")
        assert sum(pieces.scores[i] for i in ids) == best[-1]
    texts = [None, "", " ", "  a  b ", "▁", "a▁b ▁c", "\x00\x01\n\n\t", "日本語 𝔘", "long" * 5000, *samples]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, tokens array<int>")
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(df, pieces), pieces)
    assert back.columns == ["doc_id", "text", "tokens", "decoded"]
    assert all(r["text"] == r["decoded"] for r in back.collect())


def test_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = labelled.remainder(docs["doc_id"], 3) == 1
    model = language_id.train(docs.filter(~held_out))
    got = rows_by_id(language_id.predict(docs, model))
    rows = docs.filter(held_out).collect()
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    odd = spark.createDataFrame([(1, None), (2, "123 !?"), (3, "ß")], "doc_id long, text string")
    got = rows_by_id(language_id.predict(odd, model))
    assert [got[i]["lang_pred"] for i in (1, 2)] == ["und", "und"]
    assert got[3]["lang_pred"] in model.languages and 0 <= got[3]["score"] <= 1


def test_quality(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table has ten bad documents, too few to learn from
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = labelled.remainder(labels["doc_id"], 5) == 0
    model = quality.train(docs, labels.filter(~held_out))
    got = rows_by_id(quality.score(docs, model))
    rows = labels.filter(held_out).collect()
    assert sum((got[r["doc_id"]]["score"] >= 0.3) == (r["quality"] == 1) for r in rows) >= 0.9 * len(rows)
    column = pa.array(["short", "", "*** !!! ### words words words " * 400])
    dense = quality._scores(quality.Indicators(), column, model)
    single = [quality._scores(quality.Indicators(), column.slice(i, 1), model)[0] for i in range(3)]
    assert np.allclose(dense, single, atol=1e-5)


def test_html_lines():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><div class='ad big'>buy</div>"
        "<div>Site name</div><p>First &amp;  best<br>part<p>Second <b>bold</b> one<script>var a='<p>no</p>'</script>"
        "<!-- x --><div id=comments><p>reader</div><aside>side</aside><footer>foot</footer></body></html>"
    )
    text, inside = html_text.lines(page)
    assert text == ["Site name", "First & best", "part", "Second bold one"] and not any(inside)
    other = html_text.lines("<div>Site name</div><p>Other")
    assert html_text.own_text((text, inside), [other]) == "First & best part Second bold one"
    assert html_text.own_text((text, inside), [(text, inside)]) == " ".join(text)
    article = html_text.lines("<div>Site name</div><article><header><h1>T</h1></header><p>x<p>x</article><p>after")
    assert html_text.own_text(article, [article]) == "T x x"
    template = html_text.lines("<article>T<p>one<p>Share this</article>")
    assert html_text.own_text(template, [html_text.lines("<div>Share this</div><article>two</article>")]) == "T one"
    assert html_text.own_text(template, [html_text.lines("<article>other<p>Share this</article>")]) == "T one Share this"
    assert html_text.lines("") == ([], []) and html_text.lines("<p <<>> a < b") != ([], [])


def test_html_pages_are_paired_on_their_host(spark):
    body = "<div>Template of {0}</div><p>story {1}</p><div>Imprint of {0}</div>"
    rows = [(i, f"http://h{i % 3}.example/p/{i}", body.format(i % 3, i)) for i in range(30)] + [(99, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got == {i: f"story {i}" for i in range(30)} | {99: ""}


def differenced(pages):
    """Texts by url order, one page after another."""
    split = [(i, *re.match(r"https?://([^/]*)(.*)", url).groups(), html_text.lines(html)) for i, url, html in pages]
    split.sort(key=lambda p: (p[1], p[2], p[0]))
    out = {}
    for k, (i, host, path, found) in enumerate(split):
        near = [p for p in (split[k - 1] if k else None, split[k + 1] if k + 1 < len(split) else None) if p and p[1] == host]
        near.sort(key=lambda p: -html_text._alike(p[2], path))
        out[i] = html_text.own_text(found, [p[3] for p in near])
    return out


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_html_texts_do_not_depend_on_the_tasks(spark, partitions):
    """A hot host, and more tasks than other hosts have pages: every neighbour is found over the ends of tasks."""
    rng = random.Random(8)
    html = "<div>Template {0}</div><p>{1}</p><div>{2}</div><p>{3}</p>"
    pages = []
    for i in range(90):
        host = "hot" if i % 3 else f"h{rng.randrange(12)}"
        say = rng.choices("abcdef", k=3)
        pages.append((i, f"http://{host}/{rng.choice('xyz')}/{rng.randrange(30)}", html.format(host, *say)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
        got = {r["id"]: r["text"] for r in html_text.extract(df).collect()}
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == differenced(pages)


def test_html_lines_travel_packed():
    """The lines of a page are exchanged in less than half of their bytes and come back as they were."""
    rng = random.Random(3)
    words = ["".join(rng.choices("aeioulnrst\u00e9", k=rng.randrange(3, 9))) for _ in range(40)]
    html = ["".join(f"<p>{' '.join(rng.choices(words, k=30))}</p>" for _ in range(30)), "", "<article>a<p>\u00fc</article>", None]
    rows = pa.RecordBatch.from_pylist([{"id": i, "url": "u", "host": "h", "path": "p", "html": x or ""} for i, x in enumerate(html)])
    (parsed,) = html_text._parse([rows])
    wanted = [html_text.lines(x or "") for x in html]
    assert [html_text._unpacked(page) for page in parsed.to_pylist()] == wanted
    assert 2 * len(parsed.column("lines")[0].as_py()) < len("\n".join(wanted[0][0]).encode())


def test_html_without_marked_articles_gives_mostly_the_same(spark, sf_dir):
    """With all article tags taken out, differencing and the other markup find nine in ten of the texts."""
    pages = spark.read.parquet(f"{sf_dir}/../sf0.01/pages.parquet")
    marked = {r["id"]: r["text"] for r in html_text.extract(pages).collect()}
    bare = pages.withColumn("html", F.regexp_replace("html", "</?article[^>]*>", ""))
    got = {r["id"]: r["text"] for r in html_text.extract(bare).collect()}
    same = sum(got[i] == text for i, text in marked.items())
    assert same >= 0.9 * len(marked), same / len(marked)


def test_common_lines():
    rng = random.Random(1)
    for _ in range(50):
        a, b = (rng.choices("abcd", k=rng.randrange(9)) for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(html_text.common_lines(a, b)) == table[-1][-1]


def test_forest_on_held_out_findings():
    """Precision and recall on findings the forest was not fitted on, over all kinds and for each kind of secret."""
    learn = labelled_findings.labelled_findings(secrets_scan.LABELLED)
    forest = secrets_scan.fit([f[:4] for f in learn], labelled_findings.WORDS)
    held = [f for f in labelled_findings.labelled_findings(3_000, seed=99) if f[:3] not in {x[:3] for x in learn}]
    x = np.array([secrets_scan.features(c, b, a, forest.dictionary) for c, b, a, *_ in held])
    found = forest.chance(x) >= 0.5
    true = np.array([f[3] for f in held])
    assert (found & true).sum() / found.sum() >= 0.95
    assert (found & true).sum() / true.sum() >= 0.95
    kinds = np.array([f[4] for f in held])
    rates = {k: float(found[kinds == k].mean()) for k in labelled_findings.KINDS}
    print(rates)
    for kind, (secret, *_) in labelled_findings.KINDS.items():
        assert rates[kind] >= 0.8 if secret else rates[kind] <= 0.2, (kind, rates[kind])


def test_assigned_candidates():
    texts = ['password: "river-Stone" and token=abc', "Key: sk_live_0123456789abcdefgh; pwd='q!9zzkW'", None, "monkeys: none"]
    got = [(i, c) for i, _, _, c, _, _ in secrets_scan.findings(texts)]
    assert got == [(0, "river-Stone"), (1, "sk_live_0123456789abcdefgh"), (1, "q!9zzkW")]


def test_secret_scan(spark):
    rng = random.Random(6)
    token = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(60)]
    rows = [(i, f'some words here token = "{t}" and 4{rng.randrange(10**15):015d} more') for i, t in enumerate(token)]
    rows += [(100, None), (101, "see https://example.com/path1/of/some/thing"), (102, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_by_id(secrets_scan.scan(docs, secrets_scan.train(docs)))
    assert all(len(got[i]["secrets"]) == 1 and t not in got[i]["redacted"] for i, t in enumerate(token))
    assert got[100]["redacted"] is None and not got[101]["secrets"] and got[102]["n_candidates"] == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "tokens"]
    assert 0.5 * docs.count() < out.count() <= docs.count()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    groups = brute_components(list(kept.items()), corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
    assert all(alone for _, _, alone in groups.values())


def test_secret_dictionary_counts_the_words_of_all_texts(spark):
    # before, some 20,000 texts were drawn, and a word of few texts was seldom counted often enough
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('lorem ', translate(cast(id % 12000 AS string), '0123456789', 'abcdefghij'), 'word') AS text")
    rare = docs.filter("doc_id % 12000 < 50").select("text").distinct()
    words = {r["text"].split()[1] for r in rare.collect()}
    assert len(words) == 50  # each in five texts
    assert words <= secrets_scan.train(docs).dictionary


def test_near_pairs_are_sorted_out_by_short_hashes_without_loss(spark):
    # before, every pair of the last step was compared on full sets
    rng = np.random.default_rng(4)
    sets = {}
    for i, n in enumerate([1, 2, 20, 300, 20_000]):
        first = rng.integers(0, 2**64, n, dtype=np.uint64)
        sets[f"{i}x"] = first
        for j, share in enumerate([0, 0.5, 0.9, 0.92, 1]):
            keep = int(n * share)
            sets[f"{i}{j}"] = np.concatenate([first[:keep], rng.integers(0, 2**64, n - keep, dtype=np.uint64)])
    frame = spark.createDataFrame([(k.encode(), bytearray(np.sort(v).tobytes())) for k, v in sets.items()], "node binary, grams binary")
    names = sorted(sets)
    pairs = [(a, b) for a in names for b in names if a < b]
    given = spark.createDataFrame([(a.encode(), b.encode()) for a, b in pairs], "a binary, b binary")
    kept = {(bytes(r["a"]).decode(), bytes(r["b"]).decode()) for r in near_dedup._possible(given, frame, 85).collect()}
    alike = {(a, b) for a, b in pairs if 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))}
    assert alike and alike <= kept
    small = {p for p in pairs if max(len(sets[x]) for x in p) <= 300}
    assert len(small & kept - alike) <= 3 and len(kept) < len(pairs) / 2


def test_components_are_written_by_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "few", lambda df: df.coalesce(3), raising=False)
    names = [f"{i:03}".encode() for i in range(400)]
    chain = list(zip(names[1:40], names[:39], strict=True))
    star = [(names[250], x) for x in names[100:300] if x != names[250]]
    pairs = [(names[i], names[i + 1]) for i in range(300, 400, 2)]
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = near_dedup.components(spark.createDataFrame(chain + star + pairs, "a binary, b binary"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {bytes(r["node"]): bytes(r["label"]) for r in found.collect()}
    wanted = {x: names[0] for x in names[:40]} | {x: names[100] for x in names[100:300]}
    assert got == wanted | {x: names[i] for i in range(300, 400, 2) for x in names[i : i + 2]}
    assert len(found.inputFiles()) <= 3
