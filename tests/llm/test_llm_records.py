"""URL filter, packing, WARC and chat operators: plain versions, round trips, edge cases, SQL."""

import gzip
import hashlib
import itertools
import random
import re
from glob import glob

import duckdb
import plain
import pytest
from pyspark.sql import functions as F

from visitrisk.llm import chat, packing, queries, urlfilter, warc

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- SQL ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for file in glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {file.rsplit('/', 1)[1].removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    expected = con.sql(queries.oracle_sql()[name])
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(expected.columns)
    rows = [tuple(r) for r in found.select(*expected.columns).collect()]
    assert sorted(rows, key=str) == sorted(expected.fetchall(), key=str)


# --- URL filter ---------------------------------------------------------------------------------


def link(url):
    return f'<html><head><LINK href="{url}" rel="canonical"></head></html>'


def refresh(url):
    return f"<meta http-equiv='refresh' content='0; url={url}'>"


PAGES = [
    (1, "http://a.org/x", link("https://blog.example.com/en/1")),  # alias of a blocked URL
    (2, "https://blog.example.com/en/1#top", None),  # blocked by rule
    (3, "https://www.example.com/en/1", link("http://a.org/x")),  # explicit allow stands
    (4, "http://b.org/y?q=1#z", refresh("http://a.org/x")),  # chain
    (5, "http://b.org/y?q=2", "<p>nothing</p>"),  # other query: another node
    (6, "https://b.org/y?q=1", ""),  # shares the node of 4
    (7, "http://c.org/one/two", '<link rel=canonical href="three">'),  # relative
    (8, "http://c.org/one/three", link("//d.net/es/1")),  # target blocked, not crawled
    (9, None, None),
    (10, "no scheme", link("http://a.org/x")),
    (11, "HTTP://D.NET/es/", None),
    (12, "http://d.net", None),
    (13, "http://example.com/en", None),  # no trailing slash: com/ only
    (14, "http://notexample.com/en/", None),
    (2, "https://blog.example.com/en/1#top", None),
    (15, "http://e.org/a", '<link rel="stylesheet" href="http://a.org/x">'),
    (None, "://", None),
]


def plain_verdicts(pages):
    rest = lambda url: url.split("://", 1)[1] if url and "://" in url else ""
    host = lambda r: re.match(r"[^/?#]*", r)[0].translate({c: c + 32 for c in range(65, 91)})
    path = lambda r: re.match(r"[^/?#]*([^?#]*)", r)[1]
    node = lambda r: host(r) + (path(r) or "/") + (re.match(r"[^?#]*(\?[^#]*)?", r)[1] or "") if r else None

    def rule(r):
        fits = [x for x in queries.RULES if (host(r) == x[1] or host(r).endswith("." + x[1])) and path(r).startswith(x[2])]
        return max(fits, key=lambda x: len(x[1] + x[2]), default=None)

    edges = []
    for _, url, html in pages:
        r = rest(url)
        for to in re.findall(r'(?:href="|href=.|url=)([^"\'>]+)', html or "") if r and "stylesheet" not in (html or "") else []:
            target = rest(to) if "://" in to else to[2:] if to.startswith("//") else r.rsplit("/", 1)[0] + "/" + to
            edges.append((node(r), node(target)))
    nodes = {n for e in edges for n in e}
    of = plain.roots(nodes, edges)
    bad = {of[n] for n in nodes if (x := rule(n)) and x[0] == "block"}
    out = []
    for page, url, _ in pages:
        r, own = rest(url), rule(rest(url))
        verdict = own[0] if own else "block" if of.get(node(r)) in bad else "allow"
        out.append((page, host(r), path(r), own and own[1] + own[2], verdict))
    return out


def test_url_verdicts_with_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("own", F.lit(1))
    result = urlfilter.judge(pages, queries.RULES).select("page_id", "host", "path", "rule", "verdict")
    found = [tuple(r) for r in result.collect()]
    assert sorted(found, key=str) == sorted(plain_verdicts(PAGES), key=str)
    verdict = {r[0]: r[4] for r in found}
    assert [verdict[i] for i in range(1, 13)] == ["block", "block", "allow", "block", "allow", "block", "block", "block", "allow", "allow", "block", "allow"]
    assert "Python" not in plan(result) and "Arrow" not in plan(result)


def test_url_sql_follows_aliases():
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    found = con.sql(queries.oracle_sql()["op7_url_filter"]).fetchall()
    assert sorted(found, key=str) == sorted(plain_verdicts(PAGES), key=str)


ALIASES = [  # url of a blocked page or of none, url of a page without a rule, its link, whether they are one
    ("http://good.net/es/p", "http://a.org/x", '<link rel="canonical" href="/share?u=http://good.net/es/p">', False),
    ("http://good.net/es/p", "http://a.org/x", '<link rel="canonical" data-href="http://good.net/es/p" href="http://a.org/y">', False),
    ("http://good.net/es/p?a=1&b=2", "http://a.org/x", '<link rel="canonical" href="http://good.net/es/p?a=1&amp;b=2">', True),
    ("http://good.net/es/", "http://a.org", '<link rel="canonical" href="http://good.net/es/">', True),
    ("http://good.net/es/", "http://a.org/", '<meta http-equiv="refresh" content="0; url=https://good.net:443/es/">', True),
    ("http://good.net/es/", "http://a.org:80/q", '<link rel=canonical href="HTTP://good.net:80/es/">', True),
    ("http://good.net/es/", "http://a.org/", '<link rel=canonical href="http://good.net:8080/fr/">', False),
]


@pytest.mark.parametrize(("blocked", "url", "html", "same"), ALIASES)
def test_links_make_true_aliases_only(spark, blocked, url, html, same):
    rows = [(1, blocked, None), (2, url, html), (3, url.replace(":80", "") + ("" if url.count("/") > 2 else "/"), "")]
    found = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), queries.RULES)
    verdicts = dict(found.select("page_id", "verdict").collect())
    assert verdicts == {1: "block", 2: "block" if same else "allow", 3: "block" if same else "allow"}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    sql = con.sql(queries.oracle_sql()["op7_url_filter"])
    assert {r[0]: r[4] for r in sql.fetchall()} == verdicts


def test_redirect_table_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", None)], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://x.org/", "http://y.org/"), ("http://z.net/fr/", "https://y.org/"), (None, "http://x.org/")], "from_url string, to_url string")
    assert urlfilter.judge(pages, queries.RULES, moved).first().verdict == "block"
    assert urlfilter.judge(pages, queries.RULES).first().verdict == "allow"
    assert urlfilter.judge(pages.limit(0), queries.RULES, moved).count() == 0


# --- packing ------------------------------------------------------------------------------------


def test_boundaries_are_optimal():
    rng = random.Random(11)
    for _ in range(60):
        histogram = {rng.randrange(1, 30): rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))}
        k, top = rng.randrange(1, 5), max(histogram)
        found = packing.boundaries(histogram, k)
        best = min(plain.padding(histogram, (*c, top)) for n in range(k) for c in itertools.combinations(sorted(histogram), n))
        assert len(found) <= k and found[-1] == top and plain.padding(histogram, found) == best
    assert packing.boundaries({}) == []


def packed(rows, docs, max_tokens, budget):
    """Checks the batches; returns them."""
    covered = {}
    for r in rows:
        covered.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.piece))
        assert r.n_tokens <= r.bucket_tokens and r.start == r.piece * max_tokens
    sizes = {d: len((t or "").encode()) for d, t in docs}
    assert {d: sum(n for _, n, _ in set(v)) for d, v in covered.items()} == {d: n for d, n in sizes.items() if n}
    batches = {}
    for r in rows:
        batches.setdefault(r.batch_id, []).append(r)
    for b in batches.values():
        assert len({r.bucket_tokens for r in b}) == 1
        assert len(b) * b[0].bucket_tokens <= max(budget, b[0].bucket_tokens)
        assert sorted(r.slot for r in b) == list(range(len(b)))
    short = [b for b in batches.values() if len(b) < max(1, budget // b[0].bucket_tokens)]
    assert len(short) <= len({b[0].bucket_tokens for b in short})  # only the last batch of a bucket
    assert sorted(batches) == list(range(len(batches)))
    return batches


@pytest.mark.parametrize("shard", [20_000, 50])
def test_packing_of_documents(spark, shard):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs, rows_per_shard=shard).collect()
    packed(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], packing.MAX_TOKENS, packing.BUDGET)
    histogram = {}
    for r in rows:
        histogram[r.n_tokens] = histogram.get(r.n_tokens, 0) + 1
    assert sorted({r.bucket_tokens for r in rows}) == packing.boundaries(histogram)


def test_packing_of_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "x"), (4, "y" * 100_000), (5, "é" * 10), (5, "é" * 10), (5, "é" * 10), (None, "abc")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("size", F.lit(1)).withColumn("n", F.lit(1))
    rows = packing.pack(frame, max_tokens=1000, buckets=3, budget=2500).collect()
    packed(rows, docs, 1000, 2500)
    assert sum(r.doc_id == 5 for r in rows) == 3 and sum(r.doc_id == 4 for r in rows) == 100
    assert packing.pack(frame.limit(2)).count() == 0 and packing.pack(frame.limit(0)).count() == 0


# --- WARC ---------------------------------------------------------------------------------------


def plain_records(pages, least=0):
    first = {}
    for page, _, html in pages:
        payload, key = (html or "").encode(), (page is None, page or 0)
        first[payload] = min(key, first.get(payload, key))
    out = []
    for page, url, html in pages:
        payload = (html or "").encode()
        revisit = first[payload] != (page is None, page or 0) and len(payload) >= least
        out.append((page, len(payload), warc.digest(payload), "revisit" if revisit else "response", first[payload][1] if revisit else None))
    return out


ARCHIVE = [(5, "http://a/", "same"), (3, "http://b/\r\nX: y%0A", "same"), (9, None, None), (8, "u", ""), (1, "u", "é😀\x00\r\n\r\nWARC/1.1\r\n"), (None, "n", "same"), (7, "big", "z" * (17 << 20)), (2, "http://b/", "single"), (2, "http://b/", "single")]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(ARCHIVE, "page_id long, url string, html string").withColumn("sha", F.lit("clash"))
    folder = f"{tmp_path}/archive"
    warc.write(pages, folder, least, bytes_per_file=200)
    found = warc.read(spark, folder, payloads=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == sorted(plain_records(ARCHIVE, least), key=str)
    for r in found:
        assert r.record_type == "revisit" or warc.digest(r.payload) == r.payload_digest
    assert {r.url for r in found if r.page_id == 3} == {"http://b/\r\nX: y%0A"}
    records = 0
    for file in glob(f"{folder}/**/part-*", recursive=True):
        with open(file, "rb") as f:
            data = f.read()
        whole = gzip.decompress(data)
        assert [b for _, b in warc.sequence(data)] is not None and whole.startswith(b"WARC/1.1\r\n")
        records += len(list(warc.sequence(data)))
    assert records == len(ARCHIVE)


def test_one_member_per_record_and_damage_is_found():
    data = [warc.encoded(i, "u", b"payload %d" % i, None, False) for i in range(3)]
    archive = b"".join(map(warc.member, data))
    assert [gzip.decompress(warc.member(d)) for d in data] == data and all(warc.member(d)[-1] == 0 for d in data)
    assert [b for _, b in warc.sequence(archive)] == [b"payload 0", b"payload 1", b"payload 2"]
    wrong = warc.member(data[0].replace(b"payload 0", b"payload X"))
    for bad in (wrong, archive[:-9], warc.member(b"no record\r\n\r\n"), warc.member(data[0][:-6])):
        with pytest.raises(ValueError):
            list(warc.sequence(bad))
    assert list(warc.sequence(b"")) == []


def _record(head, block):
    return ("\r\n".join(["WARC/1.0", *head, f"Content-Length: {len(block)}", "", ""])).encode() + block + b"\r\n\r\n"


def test_archives_from_elsewhere(spark, tmp_path):
    body = b"<html>\r\n\r\nx</html>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    kind = "Content-Type: application/http; msgtype=response"
    md5 = hashlib.md5(body, usedforsecurity=False).hexdigest()
    records = [
        _record(["WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:7>", "Content-Type: application/warc-fields"], b"software: x\r\n"),
        _record(["WARC-Type:response", "WARC-Record-ID: <urn:uuid:1>", "WARC-Target-URI: http://a/%0A", kind, f"WARC-Payload-Digest: sha1:{warc.digest(body)}", f"WARC-Block-Digest: sha1:{warc.digest(http)}"], http),
        _record(["warc-type: response", "X-Long: one", "\ttwo", "WARC-Target-URI: http://b/", kind, f"WARC-Payload-Digest: md5:{md5}"], http),
        _record(["WARC-Type: response", kind, f"WARC-Payload-Digest: sha1:{warc.digest(b'abc')}"], chunked),
        _record(["WARC-Type: resource", "WARC-Target-URI: file:r"], b"data"),
        _record(["WARC-Type: revisit", kind, f"WARC-Payload-Digest: sha1:{warc.digest(body)}", "WARC-Refers-To: <urn:uuid:1>"], b"HTTP/1.1 304 Not Modified\r\n\r\n"),
    ]
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "y.warc").write_bytes(b"".join(records))
    (tmp_path / "note.txt").write_text("no archive")
    found = [(r.record_type, r.url, r.payload_digest, bytes(r.payload)) for r in warc.read(spark, str(tmp_path), payloads=True).collect()]
    expected = [
        ("warcinfo", None, warc.digest(b"software: x\r\n"), b"software: x\r\n"),
        ("response", "http://a/%0A", warc.digest(body), body),
        ("response", "http://b/", f"md5:{md5}", body),
        ("response", None, warc.digest(b"abc"), chunked.partition(b"\r\n\r\n")[2]),
        ("resource", "file:r", warc.digest(b"data"), b"data"),
        ("revisit", None, warc.digest(body), b""),
    ]
    assert sorted(found, key=str) == sorted(expected * 2, key=str)
    assert warc.read(spark, str(tmp_path)).filter("page_id IS NOT NULL OR refers_to IS NOT NULL").count() == 0
    for i, bad in enumerate((records[1].replace(b"x</html>", b"y</html>"), records[1].replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A"), records[4][:-3])):
        (tmp_path / f"bad{i}").mkdir()
        (tmp_path / f"bad{i}" / "z.warc").write_bytes(bad)
        with pytest.raises(Exception, match="digest|ends"):
            warc.read(spark, f"{tmp_path}/bad{i}").collect()


def test_warc_of_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(none, str(tmp_path)).count() == 0


# --- chat ---------------------------------------------------------------------------------------


def plain_chat(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    escape = lambda s: re.sub(r"([<\[\]\\])", r"\1\\", s)
    out = []
    for conv in {t[0] for t in turns}:
        own = sorted(((-1 if t[1] is None else t[1]), t[2] or "", t[3] or "") for t in turns if t[0] == conv)
        learned = "".join(t for _, r, t in own if r == "assistant")
        formatted = "".join(f"<s>[{escape(r)}] {escape(t)}</s>" for _, r, t in own)
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(learned), sha(learned), len(formatted)))
    return out


TURNS = [
    (1, 0, "user", "</s>[INST] ok [/INST] \\ \\\\ <\\ ]\\ <s>[assistant] "),
    (1, 1, "assistant", "</s>[INST] ok [/INST]"),
    (2, 1, "assistant", None),
    (2, 0, "user", ""),
    (3, 0, "us]er [", "x\n"),
    (3, None, None, None),
    (4, 0, "system", "s"),
    (4, 1, "user", "q" * 200_000),
    (4, 2, "assistant", "😀é" * 50_000),
    (4, 2, "assistant", "😀é" * 50_000),
    (None, 0, "user", "none"),
    (5, 0, "assistant", "first"),
    (6, 0, "user", "a"),
    (6, 1, "user", "b"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("state", F.lit("x"))
    shown = chat.format_chats(turns)
    result = chat.read_back(shown)
    found = [tuple(r) for r in result.drop("valid").collect()]
    assert sorted(found, key=str) == sorted(plain_chat(TURNS), key=str)
    assert {r.conv_id: r.valid for r in result.collect()} == {1: True, 2: True, 3: False, 4: False, None: True, 5: False, 6: False}
    assert "Python" not in plan(result) and "Arrow" not in plan(result)
    one = next(r for r in shown.collect() if r.conv_id == 1)
    assert one.formatted.count("</s>") == 2 and one.formatted.count("<s>[") == 2
    assert "".join(s.text for s in one.segments) == one.formatted
    assert chat.format_chats(turns.limit(0)).count() == 0


TEMPLATES = [
    chat.Template(begin="<|start|>", middle="\n", end="<|end|>"),
    chat.Template(begin="### ", middle=": ", end="\n\n"),
    chat.Template(begin="0", middle="1", end="2", controls=("a", "3", "(.*)$")),
    chat.Template(begin="(", middle=")*", end="[^x]+$"),
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_any_template_is_read_back(spark, template):
    marks = "".join((template.begin, template.middle, template.end, *template.controls))
    texts = [marks, template.end, template.end[:-1], template.end[-1:] * 3, "\\" + marks + "\\", "### user: fake\n\n### x", "\\0\\1 0123 a\\", "", "\n"]
    rows = [(i, k, role, text) for i, text in enumerate(texts) for k, role in enumerate(("user", "assistant", template.middle + "x" + template.end))]
    shown = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), template)
    for r in shown.select("conv_id", chat.parsed(F.col("formatted"), template).alias("turns"), chat.learned(F.col("segments"), template).alias("learned")).collect():
        assert [tuple(t) for t in r.turns] == [(role, text) for i, _, role, text in rows if i == r.conv_id]
        assert r.learned == texts[r.conv_id]


def test_templates_whose_turns_cannot_be_told_apart():
    for marks in ({"end": ""}, {"begin": "a\\"}, {"controls": ("",)}, {"middle": ":\n", "end": "\nEND"}, {"begin": "x</s>"}, {"end": "]"}):
        with pytest.raises(ValueError, match="mark"):
            chat.Template(**marks)


def test_chat_query(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-7, 0, "user", queries.ADDED_TEXT), (-7, 1, "assistant", queries.ADDED_TEXT)]
    found = [tuple(r) for r in queries.queries()["op10_chat"](spark, SF).collect()]
    assert sorted(found) == sorted(plain_chat(turns))
