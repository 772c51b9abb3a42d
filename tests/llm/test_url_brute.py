"""Operator 1 against a plain reading of its method, with constants of its
own, over whole tables."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.conftest import SF01
from tidepool.llm.queries import RULES, op1

SF1 = SF01.replace("0.01", "0.1")


def _parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)), m.group(2)) if m else ("", "")


def _rule(host, path):
    fits = []
    for rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return max(fits, key=len, default=None)


def _chi(n, bad, n0, bad0):
    both = bad + bad0
    scale = both * (n + n0 - both) * n * n0
    return (bad * n0 - bad0 * n) ** 2 * (n + n0) / scale if scale > 0 else 0.0


def _clusters(rates):
    """Lowest rates of the clusters of {rate: [labelled, bad]}."""
    acc = [(r, *c, *c, *c) for r, c in sorted(rates.items())]
    while len(acc) > 1:
        gaps = [(max(_chi(*a[1:3], *b[1:3]), _chi(*a[3:5], *b[5:7])), i) for i, (a, b) in enumerate(zip(acc, acc[1:]))]
        gap, i = min(gaps)
        if gap > 3.841:
            break
        a, b = acc[i:i + 2]
        acc[i:i + 2] = [(a[0], a[1] + b[1], a[2] + b[2], *a[3:5], *b[5:7])]
    return [c[0] for c in acc]


def _name(own, every):
    if len(own) == 1:
        return own[0]
    if len(own) == every:
        return "*"
    whole = "|".join(own)
    if len(own) <= 21:
        return "{" + whole + "}"
    return "{" + "|".join(own[:21]) + f"|+{len(own) - 21}#" + hashlib.md5(whole.encode()).hexdigest() + "}"


def brute(pages, bad_of):
    rows = []
    for page_id, url in pages:
        host, path = _parts(url)
        m = re.search(r"/([0-9]+)(\.html)?/?$", path)
        key = int(m.group(1)) if m and int(m.group(1)) < 2 ** 63 else None
        rows.append(dict(id=page_id, host=host, path=path, segs=[s for s in path.split("/") if s], bad=bad_of.get(key), t=()))
    for r in rows:
        r["deep"] = len(r["segs"]) > 3
    for level in range(3):
        n, labelled, total = Counter(), Counter(), Counter()
        for r in rows:
            r["seg"] = r["segs"][level] if len(r["segs"]) > level else ""
            k = (r["host"], r["t"])
            total[k] += 1
            n[k, r["seg"]] += 1
            labelled[k, r["seg"]] += r["bad"] is not None
        for r in rows:
            k, s = (r["host"], r["t"]), r["seg"]
            stays = s and n[k, s] >= 3 and (n[k, s] >= total[k] * 0.05 or labelled[k, s] >= 10)
            r["t"] += ("" if not s else s if stays else "*",)
    rest, level = rows, 3
    while True:
        support = Counter()
        for r in rest:
            support[r["host"], r["t"]] += r["deep"] and r["bad"] is not None
        rest = [r for r in rest if r["deep"] and support[r["host"], r["t"]] >= 10]
        if not rest:
            break
        labelled = Counter((r["host"], r["t"], r["segs"][level]) for r in rest if r["bad"] is not None)
        for r in rest:
            s = r["segs"][level]
            r["t"] += (s if labelled[r["host"], r["t"], s] >= 10 else "*",)
            r["deep"] = len(r["segs"]) > level + 1
        level += 1
    nodes = defaultdict(lambda: [0, 0])
    for r in rows:
        r["t"] += ("",) * (level - len(r["t"]))
        c = nodes[r["host"], r["t"], r["deep"]]
        c[0] += r["bad"] is not None
        c[1] += r["bad"] or 0
    merged = {k: k[1] for k in nodes}
    for i in range(level - 1, -1, -1):
        branches = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for k, m in merged.items():
            b = branches[k[0], k[2], m[:i], m[i + 1:], m[i] == ""][m[i]]
            b[0] += nodes[k][0]
            b[1] += nodes[k][1]
        named = {}
        for sib, own in branches.items():
            rates = defaultdict(lambda: [0, 0])
            for n, b in own.values():
                if n:
                    rates[b / n][0] += n
                    rates[b / n][1] += b
            starts = _clusters(rates)
            groups = defaultdict(list)
            for s, (n, b) in sorted(own.items()):
                at = max(x for x in starts if x <= b / n) if n else starts[0] if starts else -1
                groups[at].append(s)
            for members in groups.values():
                named.update({(sib, s): _name(members, len(own)) for s in members})
        merged = {k: (*m[:i], named[(k[0], k[2], m[:i], m[i + 1:], m[i] == ""), m[i]], *m[i + 1:]) for k, m in merged.items()}
    pure = defaultdict(lambda: [0, 0])
    for k, m in merged.items():
        pure[k[0], k[2], m][0] += nodes[k][0]
        pure[k[0], k[2], m][1] += nodes[k][1]
    all_n, all_b = (sum(c[j] for c in nodes.values()) for j in (0, 1))
    prior = all_b / all_n if all_n else 0.0
    out = []
    for r in rows:
        m = merged[r["host"], r["t"], r["deep"]]
        n, b = pure[r["host"], r["deep"], m]
        rule = _rule(r["host"], r["path"])
        verdict = RULES[rule] if rule else "block" if (b + 10 * prior) / (n + 10) >= 0.5 else "allow"
        template = r["host"] + "".join("/" + s for s in m if s) + ("/**" if r["deep"] else "")
        out.append((r["id"], r["host"], r["path"], rule, verdict, template))
    return out


@pytest.mark.parametrize("sf", [SF01, SF1])
def test_whole_tables_follow_the_method(spark, sf):
    con = duckdb.connect()
    pages = con.execute(f"select page_id, url from '{sf}/pages.parquet'").fetchall()
    bad = dict(con.execute(f"select doc_id, max(greatest(1 - quality, toxic)) from '{sf}/labels.parquet' where doc_id is not null "
                           "and greatest(1 - quality, toxic) is not null group by 1").fetchall())
    got = op1(spark, sf).select("page_id", "host", "path", "rule", "verdict", "template").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(pages, bad), key=repr)


def test_a_plan_of_merging_holds_one_level(spark, monkeypatch):
    """Each level names the one before three times: in one plan, three levels had 13 windows."""
    from tidepool.llm import url_templates as ut
    windows, write = [], ut.written

    def counted(df, name):
        windows.append(df._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
        return write(df, name)

    monkeypatch.setattr(ut, "written", counted)
    rows = [("h.org", a, b, c, False, 20, 20 * (a == "x")) for a in "xyz" for b in "pq" for c in "12"]
    counts = spark.createDataFrame(rows, "host string, t1 string, t2 string, t3 string, deep boolean, labelled long, bad long")
    got = ut.merged_templates(counts)
    windows.append(got._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
    assert max(windows) == 1
    assert {(r["t1"], r["m1"], r["m2"], r["m3"]) for r in got.collect()} == {("x", "x", "*", "*"), ("y", "{y|z}", "*", "*"), ("z", "{y|z}", "*", "*")}
