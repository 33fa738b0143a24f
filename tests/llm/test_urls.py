"""The automaton against regular expressions."""

from __future__ import annotations

import random
import re
import string

from stayledger.llm import urls
from stayledger.llm.queries import URL_RULES


def regex_of(pattern):
    parts = {"all": "[\\s\\S]*", "some": "[^/]*", "any": "[\\s\\S]"}
    return re.compile("".join(re.escape(c) if kind == "one" else parts[kind] for kind, c in urls.symbols(pattern)))


def test_random_globs_over_many_words():
    rng = random.Random(1)
    patterns = ["".join(rng.choices(["a", "b", "/", ".", "é", "*", "**", "?"], k=rng.randrange(9))) for _ in range(90)]
    patterns += ["", "*", "**", "a" * 70 + "*", "**" + "b" * 130]
    machine = urls.Automaton([urls.symbols(p) for p in patterns])
    assert machine.words > 8
    texts = ["".join(rng.choices("ab/.é\u4e00\U0001f600", k=rng.randrange(12))) for _ in range(500)]
    texts += ["", "a" * 70, "a" * 200, "x" + "b" * 130, "a/" * 300]
    fits = machine.accepts(texts)
    for p, pattern in enumerate(patterns):
        matcher = regex_of(pattern)
        assert [bool(matcher.fullmatch(t)) for t in texts] == list(fits[:, p]), pattern


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def simplest(host, path):
    """The canonical URL, character by character."""
    out = []
    for part in (host, path):
        done, i = "", 0
        while i < len(part):
            code = part[i + 1 : i + 3] if part[i] == "%" else ""
            if re.fullmatch("[0-9a-fA-F]{2}", code) and chr(int(code, 16)) in string.ascii_letters + string.digits + "-._~":
                done, i = done + chr(int(code, 16)), i + 3
            else:
                done, i = done + part[i], i + 1
        out.append("".join(c.lower() if c in string.ascii_uppercase else c for c in done))
    host = out[0].split("@")[-1]
    if ":" in host and not set(host.split(":")[-1]) - set("0123456789"):
        host = host[: host.rindex(":")]
    while host.endswith("."):
        host = host[:-1]
    return host + out[1]


def test_canonical():
    rng = random.Random(5)
    for _ in range(3000):
        host, path = ("".join(rng.choices(["%", "6", "1", "e", "2", "5", "7", "E", "@", ":", ".", "A", "é", "%65", "%2e", "%7E", "%5f"], k=rng.randrange(9))) for _ in range(2))
        assert urls.canonical(host, "/" + path) == simplest(host, "/" + path), (host, path)


def test_judge(spark):
    cases = [
        "http://u@SP%61m.net.:80/x", "http://x.net/a.%65xe", "http://x.net/a.EXE", "http://x.net:8080/a.Zip#z", "http://c%41sino./", "http://x.net/%2565xe",
        "http://a@spam@x.net/", "http://x.net%2Fspam/", "http://my.spam-farm.org:80/", "http://x.net./a%2eexe?x", "http://%/%%36%zz.exe",
        None, "", "no scheme", "http://", "://x", "http://ORG/", "http://org", "http://x.org/a?b/c", "http://xorg/a", "http://example.org/es/",
        "http://a.Example.org/en/17#t", "http://example.org/en/2", "https://b.com/de/1", "https://b.com/fr/1", "https://b.com/DE/1",
        "http://my.spam-farm.net/x", "http://spam.net", "http://x.net/spam", "http://x.net/a/b.exe", "http://x.net/a.exe?q", "http://spam.org/x",
        "http://É.org/\nx", "a://b://c.org/x", "http://x.org#f", "http://x.org?q", "http://" + "a." * 5000 + "org/" + "p" * 9000, "http://x.com/fr/1", "http://x.com/fr/1",
    ]
    frame = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(cases)], "page_id long, url string, host int, verdict string")
    got = {r.page_id: r for r in urls.judge(frame, URL_RULES).collect()}
    assert len(got) == len(cases)
    for i, url in enumerate(cases):
        host, path = plain(url)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        blocked = any(regex_of(g.pattern).fullmatch(simplest(host, path)) for g in urls.GLOBS)
        verdict = best.verdict if best else ("block" if blocked else "allow")
        row = got[i]
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, best and best.name, verdict), url


def test_allowing_globs_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "http://spam.good.net/x")], "page_id long, url string")
    globs = [urls.Glob("block", "*spam*/**"), urls.Glob("allow", "*.good.net/**")]
    assert urls.judge(frame, [], globs).first().verdict == "allow"
    assert urls.judge(frame, [], [], default="block").first().verdict == "block"
    assert urls.judge(frame.limit(0), URL_RULES).count() == 0
