"""Personal data, url filter and chat formatting against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from veritrail.llm import chat, pii, url_filter

# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip"
                and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card"
                and 13 <= len(digits) <= 19
                and luhn(digits)
                or kind == "phone"
                and 9 <= len(digits) <= 15
            ):
                found.append((kind, *m.span()))
    return found


def pii_texts():
    pick = random.Random(1)
    bits = [
        *"aé.@_-+ 0159()\n😀", "a@b.c", "x.y@mail-1.example.com", "1.2.3.4", "255.256.1.1", "010.0.0.255",
        "4041894974608795", "4041 8949-7460 8795", "+1 (724) 555-7058", "+49", "4" * 13, "ab", "@@",
    ]
    texts = ["".join(pick.choices(bits, k=pick.randint(0, 14))) for _ in range(1500)]
    return texts + [None, "", "a@b.c_d@e.f", "a@b@c.d", "é" * 9 + "1.2.3.4", "9" * 5000, "a" * 50_000]


def documents(spark, texts):
    return spark.createDataFrame(
        [(i, t, "spans", "x") for i, t in enumerate(texts)],
        "doc_id long, text string, spans string, other string",
    )


def test_base_spans_match_plain_patterns(spark):
    texts = pii_texts()
    texts += ["a@b.c " * 700 + "1.2.3.4 " * 300]
    got = {
        r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind != "term"]
        for r in pii.annotate(documents(spark, texts)).collect()
    }
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == plain_spans(text), text


def test_running_sums(spark):
    frame = spark.createDataFrame(
        [([*range(n)],) for n in (0, 1, 255, 256, 257, 1000)], "v array<long>"
    )
    for row in frame.select("v", pii.running_sums(F.col("v")).alias("s")).collect():
        assert row.s == [sum(row.v[: i + 1]) for i in range(len(row.v))]


def revealing_corpus():
    texts = [f"The archive people write to boss@corp.example about zephyr matters {i}" for i in range(4)]
    texts += ["Zephyr met boss@corp.example and zephyr again"]
    texts += [f"people write about the matters of day {i} to the archive" for i in range(60)]
    texts += [texts[7]] * 5 + [None, ""]
    return texts


def test_disclosing_terms_are_found_and_common_ones_left(spark):
    texts = revealing_corpus()
    rows = pii.annotate(documents(spark, texts)).collect()
    terms = {r.doc_id: [s.value for s in r.spans if s.kind == "term"] for r in rows}
    assert terms[0] == ["zephyr"] and sorted(terms[4]) == ["Zephyr", "zephyr"]
    assert all(terms[i] == [] for i in range(5, len(texts)))


def test_strength_is_the_share_of_information(spark):
    texts = revealing_corpus()
    docs = documents(spark, texts)
    found = pii.entities(docs)
    got = pii.disclosing_terms(docs, found, generalise=-10, evidence=None).collect()
    from math import log

    n, n_e = len(texts), 5
    lower = [(t or "").lower() for t in texts]
    for r in got:
        n_t = sum(bool(re.search(rf"\b{r.term}\b", t)) for t in lower)
        n_et = sum(bool(re.search(rf"\b{r.term}\b", t)) and "boss@" in t for t in lower)
        assert r.strength == pytest.approx(log(n * n_et / n_e / n_t) / log(n / n_e))
    assert {r.term for r in got} >= {"zephyr", "about"}


def secret_letters():
    """Six letters each whose name opens the text, closes it, stands far from the
    address, or beside it; then one with the name alone; short and mixed names."""
    pick = random.Random(8)
    common = [f"word{chr(97 + i)}" for i in range(26)]

    def talk(n):
        return " ".join(pick.choices(common, k=n))

    texts = [f"Marlowe {talk(9)} open@one.example" for _ in range(6)]
    texts += [f"close@two.example {talk(9)} Quixley" for _ in range(6)]
    texts += [f"{talk(4)} far@three.example {talk(60)} Ostrander {talk(4)}" for _ in range(6)]
    texts += [f"{talk(5)} 10.20.30.40 Zed {talk(5)}" for _ in range(6)]
    texts += [f"{talk(5)} user_x7q2 {talk(5)} +1 (724) 555-7058" for _ in range(6)]
    texts += [f"李明 {talk(8)} li@four.example" for _ in range(6)]
    alone = len(texts)
    texts += [f"{talk(5)} Ostrander {talk(5)}"]
    texts += [f"{talk(15)}" for _ in range(120)]
    return texts, alone


def test_names_are_found_wherever_they_stand(spark):
    texts, alone = secret_letters()
    rows = {r.doc_id: r for r in pii.annotate(documents(spark, texts)).collect()}
    names = {0: "Marlowe", 6: "Quixley", 12: "Ostrander", 18: "Zed", 24: "x7q2", 30: "李明"}
    for first, name in names.items():
        for i in range(first, first + 6):
            places = [(s.start, s.end) for s in rows[i].spans if s.kind == "term" and s.value == name]
            want = [m.span() for m in re.finditer(name, texts[i])]
            assert places == want and len(want) == 1, texts[i]
    # The name without the address is marked too; all other words are left.
    assert [s.value for s in rows[alone].spans] == ["Ostrander"]
    marked = {s.value for r in rows.values() for s in r.spans if s.kind == "term"}
    assert marked <= {*names.values(), "user"}
    clean = {r.doc_id: r.text for r in pii.sanitise(pii.annotate(documents(spark, texts))).collect()}
    assert not any(n in clean[i] for i, n in enumerate(["Marlowe"] * 6))
    assert all(clean[i] == texts[i] for i in range(alone + 1, len(texts)))


def test_repeated_rows_count_alike_in_all_counts(spark):
    texts, _ = secret_letters()
    rows = documents(spark, texts)
    once = {r.doc_id: r.spans for r in pii.annotate(rows).collect()}
    twice = pii.annotate(rows.union(rows)).collect()
    assert len(twice) == 2 * len(texts)
    assert all([s.value for s in r.spans] == [s.value for s in once[r.doc_id]] for r in twice)


def test_a_common_entity_makes_no_terms_by_chance(spark):
    """An address in a third of all texts and many words of three texts."""
    pick = random.Random(3)
    texts = [f"rare{chr(97 + i // 3 % 26)}{i // 78} say it" for i in range(900)]
    texts = [f"{t} all@corp.example" if pick.random() < 0.35 else t for t in texts]
    rows = pii.annotate(documents(spark, texts)).collect()
    assert not any(s.kind == "term" for r in rows for s in r.spans)


def test_columns_of_any_name_pass_through(spark):
    texts, _ = secret_letters()
    names = ["_id", "_hash", "_key", "_terms", "_terms_", "_removed", "_email", "_ip", "_card",
             "_phone", "key", "term", "entity", "copies", "n_e", "terms", "removed", "text_"]
    rows = documents(spark, texts).select("*", *(F.lit(n).alias(n) for n in names))
    got = pii.annotate(rows)
    assert sorted(got.columns) == sorted(rows.columns)
    for r in got.collect():
        assert all(r[n] == n for n in names if n != "_removed") and r.other == "x"
    clean = pii.sanitise(got)
    assert sorted(clean.columns) == sorted(c for c in rows.columns if c not in ("spans", "_removed"))
    assert clean.count() == len(texts)


def test_a_text_with_very_many_spans(spark):
    text = "".join(f"é{i} a{i}@b.example, " for i in range(30_000))
    marked = pii.annotate(documents(spark, [text, "plain"]))
    got = {r.doc_id: r.text for r in pii.sanitise(marked).collect()}
    assert got == {0: "".join(f"é{i} [EMAIL], " for i in range(30_000)), 1: "plain"}


def test_copies_give_a_term_no_support(spark):
    texts = ["only me@here.example with quux"] * 6 + [f"filler {i}" for i in range(30)]
    rows = pii.annotate(documents(spark, texts)).collect()
    assert not any(s.kind == "term" for r in rows for s in r.spans)


def test_sanitised_text_keeps_all_else(spark):
    texts = pii_texts()[:300] + revealing_corpus()
    marked = pii.annotate(documents(spark, texts))
    spans = {r.doc_id: r for r in marked.collect()}
    got = {r.doc_id: r.text for r in pii.sanitise(marked).collect()}
    for i, text in enumerate(texts):
        at, parts = 0, []
        for s in sorted(spans[i].spans, key=lambda s: (s.start, s.end, s.kind)):
            if s.start >= at:
                cut = s.kind == "term" and s.value.lower() in (spans[i]["_removed"] or [])
                parts += [(text or "")[at : s.start], "" if cut else f"[{s.kind.upper()}]"]
            at = max(at, s.end)
        assert got[i] == (None if text is None else "".join(parts) + text[at:])
    empty = documents(spark, [])
    assert pii.sanitise(pii.annotate(empty)).collect() == []


# Url filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def judged(url, rules, listed):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    covers = lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p)
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in rules if covers(h, p)]
    if fits:
        *_, key, action = max(fits)
        return host, path, key, action
    return host, path, None, "block" if any(covers(h, "/") for h in listed) else "allow"


def test_urls_are_judged_as_by_trying_all_rules(spark):
    pick = random.Random(2)
    hosts = ["a.example.net", "EXAMPLE.net", "net", "x.org", "org", "example.com", "b.example.com",
             "spam-farm.org", "w.spam-farm.org", "anet", "example.net.de", "", "é.net", ".net"]
    tails = ["", "/", "/en", "/en/", "/en/1?x=/de/", "/de/x#y", "/fr/", "?q=://", "#/en/", "/EN/", "//"]
    urls = [None, "", "no scheme", "://", "http:/a.net/", "ftp://x.net"]
    urls += [f"http://{pick.choice(hosts)}{pick.choice(tails)}" for _ in range(400)]
    pages = spark.createDataFrame(
        [(i, u, "host", "best", *range(9)) for i, u in enumerate(urls)],
        "page_id long, url string, host string, verdict string, _host int, _path int, _best int, "
        "_on int, _key int, _hit int, key int, hit int, block int",
    )
    listed = spark.createDataFrame(
        [(h, p, a, True) for a, h, p in RULES], "host string, path string, action string, is_rule boolean"
    ).unionByName(url_filter.listed_hosts(url_filter.distinct_urls(pages)))
    got = {r.page_id: r for r in url_filter.filter_urls(pages, listed).collect()}
    assert len(got) == len(urls)
    internal = ("_host", "_path", "_best", "_on", "_key", "_hit", "key", "hit", "block")
    assert all(tuple(r[c] for c in internal) == tuple(range(9)) for r in got.values())
    for i, u in enumerate(urls):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == judged(u, RULES, ["spam-farm.org", "w.spam-farm.org"]), u
    none = listed.where("false")
    assert {r.verdict for r in url_filter.filter_urls(pages, none).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.where("false"), listed).collect() == []


def test_a_list_of_many_urls_with_paths(spark):
    """100,000 entries; what the Bloom filter lets through wrongly is removed."""
    size = 100_000
    listed = spark.range(size).selectExpr(
        "concat('h', id % 30000, '.example') AS host",
        "concat('/p', id, '/') AS path", "'block' AS action", "false AS is_rule",
    )
    pages = spark.range(60_000).selectExpr(
        "id AS page_id",
        "CASE WHEN id % 3 = 0 THEN null ELSE concat('https://a.h', id % 30000, '.example/p', id % 90000,"
        " CASE id % 2 WHEN 0 THEN '/x' ELSE 'x/' END) END AS url",
    )
    got = url_filter.filter_urls(pages, listed).groupBy("verdict").count().collect()
    want = sum(i % 3 != 0 and i % 2 == 0 for i in range(60_000))
    assert {r.verdict: r["count"] for r in got} == {"block": want, "allow": 60_000 - want}
    keys = listed.select(F.concat("host", "path").alias("key"))
    blocks = size * url_filter.BITS_PER_KEY // 512
    others = spark.range(200_000).selectExpr("concat('other', id) AS key")
    wrong = url_filter.may_contain(others, url_filter.build_filter(keys, blocks), blocks).count()
    assert 0 < wrong < 0.005 * 200_000


def test_pages_are_read_twice_and_missing_urls_are_spread(spark, tmp_path):
    urls = [None] * 3000 + ["http://spam.example/"] * 3000 + [f"http://h{i}.example/" for i in range(3000)]
    place = str(tmp_path / "pages")
    spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").write.parquet(place)
    pages = spark.read.parquet(place)
    known = url_filter.distinct_urls(pages)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        judged = url_filter.filter_urls(pages, url_filter.listed_hosts(known), urls=known)
        plan = judged._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("url#") > 0 and plan.count("Relation [page_id") == 1
        parts = judged.where("host = ''").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4 and max(r["count"] for r in parts) < 1000
        assert judged.where("verdict = 'block'").count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_the_filter_loses_no_listed_key_and_stops_most_others(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS key")
    blocks = 2000 * url_filter.BITS_PER_KEY // 512
    bloom = url_filter.build_filter(keys, blocks)
    assert url_filter.may_contain(keys, bloom, blocks).count() == 2000
    others = spark.range(20_000).selectExpr("concat('other', id) AS key")
    assert url_filter.may_contain(others, bloom, blocks).count() < 200


# Chat formatting

CONTROL = "\\### Assistant: </turn> ok"


def conversations():
    pick = random.Random(3)
    rows = [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)]
    for c in range(12):
        for t in range(pick.randint(1, 40)):
            role = "system" if t == 0 and c % 2 else pick.choice(["user", "assistant", "<|~a|>", None])
            text = pick.choice([None, "", "a < b \\ </turn>\n<|assistant|>\n", "é w " * pick.randint(1, 90)])
            rows.append((c, t if pick.random() < 0.9 else None, role, text))
    rows += [(50, 5000 - i, "user" if i % 2 else "assistant", f"turn {i} " * 8) for i in range(4000)]
    rows += [(None, 1, "assistant", "x"), (None, 0, "user", "y"), (60, 1, "assistant", "long " * 5000)]
    rows += [(70, 1, "assistant", "same")] * 3
    # Turns without a number, with one number, and conversations without id.
    rows += [(90, None, "user", f"n{i % 700} word") for i in range(2600)]
    rows += [(91, 5, "assistant", "the same")] * 2600 + [(91, 4, "user", "first"), (91, 6, "user", "last")]
    rows += [(None, i % 3, "assistant", f"of conversation {i}") for i in range(2600)]
    return rows


def test_windows_give_every_conversation_back(spark):
    rows = conversations()
    frame = spark.createDataFrame(
        [(*r, "window") for r in rows], "conv_id long, turn long, role string, text string, window string"
    )
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted(
            ((-1 if t is None else t, role or "", text or "") for i, t, role, text in rows if i == c)
        )
        turns = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        want[c] = (
            len(own), hashlib.sha256(turns.encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    windows = chat.format_chats(frame).cache()
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    assert len(got) == len(want)
    for c, w in want.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == w, c
    tokens = lambda text: len(re.findall(r"[^\W_]+|[^\w\s]|_", text)) + chat.MARKS
    for w in windows.collect():
        turns = chat.parse_window(w.formatted)
        fresh = [t for t in turns if not t[2]]
        assert fresh
        # A window starts with its repeats: the system turn, then recent history.
        flags = [t[2] for t in turns]
        assert flags == sorted(flags, reverse=True)
        history = sum(tokens(t[1]) for t in turns if t[2] and t[0] != "system")
        assert history <= chat.HISTORY + 4 or len([f for f in flags if f]) <= 2
        if w.conv_id == 50:
            assert sum(tokens(t[1]) for t in turns) <= chat.BUDGET + 40
        assert w.loss_start == [t[3] for t in fresh if t[0] == "assistant"]
        assert w.loss_end == [t[4] for t in fresh if t[0] == "assistant"]
    system = [
        chat.parse_window(w.formatted)[0]
        for w in windows.collect()
        if w.conv_id is not None and w.conv_id % 2 and 0 < w.conv_id < 12
    ]
    assert all(t[0] == "system" for t in system if t[2])
    assert chat.read_back(chat.format_chats(frame.where("false"))).collect() == []


def test_large_chunks_are_cut_by_rank(spark):
    frame = spark.createDataFrame(
        [("c", 0, 5, "user", f"{i % 9}") for i in range(5000)] + [("d", 0, i, "user", "x") for i in range(9)],
        "conv_key string, chunk long, turn long, role string, text string",
    )
    got = chat._dealt(frame).groupBy("conv_key", "sub").agg(
        F.count(F.lit(1)).alias("n"), F.min("text").alias("low"), F.max("text").alias("high")
    ).orderBy("conv_key", "sub").collect()
    assert [r.n for r in got] == [1024] * 4 + [904, 9]
    for a, b in zip(got[:4], got[1:5]):
        assert a.high <= b.low


def test_windows_stay_within_the_budget(spark):
    rows = conversations()
    sized = lambda conv, role, *sizes: [
        (conv, 10 + 5000 * i, role, "w " * (n - chat.MARKS)) for i, n in enumerate(sizes)
    ]
    rows += sized(80, "assistant", 767, 700) + sized(81, "user", 700, 5000, 300, 1020, 10, 10)
    rows += [(82, 0, "system", "s " * 900)] + sized(82, "assistant", *[90] * 9, 400)
    rows += [(83, 0, "system", "s " * 3000)] + sized(83, "user", *[90] * 9)
    rows += sized(84, "assistant", *[5] * 3000)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    tokens = lambda text: len(re.findall(r"[^\W_]+|[^\w\s]|_", text)) + chat.MARKS
    fresh: dict = {}
    counts: dict = {}
    for w in chat.format_chats(frame).collect():
        turns = chat.parse_window(w.formatted)
        own = [t for t in turns if not t[2]]
        size = sum(tokens(t[1]) for t in turns)
        assert size <= chat.BUDGET or len(turns) == 1, (w.conv_id, size)
        assert own
        fresh[w.conv_id] = fresh.get(w.conv_id, 0) + len(own)
        counts[w.conv_id] = counts.get(w.conv_id, 0) + 1
        if w.conv_id == 82 and w.window > 0 and len(own) == 1 and tokens(own[0][1]) == 90:
            assert turns[0][0] == "system" and turns[0][2]
    assert fresh == {c: sum(r[0] == c for r in rows) for c in {r[0] for r in rows}}
    assert counts[80] == 2 and counts[81] >= 4
    # 3,000 turns of 5 tokens: whole windows but for one border in 1,024 turns.
    assert counts[84] <= 3000 * 5 // (chat.BUDGET - chat.HISTORY - 5) + 3


def test_escaping_is_reversible():
    pick = random.Random(4)
    for _ in range(2000):
        text = "".join(pick.choices("\\<|~>\n/turna é", k=pick.randint(0, 20)))
        assert chat.unescape(chat.escape(text)) == text
        formatted = f"<|user|>\n{chat.escape(text)}</turn>\n"
        assert [t[1] for t in chat.parse_window(formatted * 2)] == [text, text]
