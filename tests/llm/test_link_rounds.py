"""Trust over long chains and cycles of links, against a dense computation and the SQL."""

import random

import duckdb
import numpy as np

from vicinal.llm.queries import RULES
from vicinal.llm.queries_sql import SQL
from vicinal.llm.url_filters import DAMPING, TOLERANCE, judge_urls, spread


def test_scores_equal_the_fixed_point(spark):
    rng, hosts = random.Random(3), 25
    links = {(a, b): rng.randint(1, 4) for a in range(hosts) for b in rng.sample(range(hosts), 2) if a != b and a % 5}
    out = {a: sum(n for (x, _), n in links.items() if x == a) for a, _ in links}
    edges = spark.createDataFrame([("trust", f"h{a}", f"h{b}", n / out[a]) for (a, b), n in links.items()], "kind string, src string, dst string, share double")
    seeds = spark.createDataFrame([("trust", "h1", 0.25), ("trust", "h7", 0.75)], "kind string, host string, seed double")
    matrix, start = np.zeros((hosts, hosts)), np.zeros(hosts)
    for (a, b), n in links.items():
        matrix[b, a] = n / out[a]
    start[[1, 7]] = 0.25, 0.75
    exact = np.linalg.solve(np.eye(hosts) - DAMPING * matrix, (1 - DAMPING) * start)
    got = {r["host"]: r["score"] for r in spread(edges, seeds).collect()}
    assert sum(abs(exact[h] - got.get(f"h{h}", 0.0)) for h in range(hosts)) <= TOLERANCE
    assert all(f"h{h}" in got for h in range(hosts) if exact[h] > 0)


def test_a_long_chain_is_followed_to_its_end_and_equals_the_sql(spark):
    def page(n, host, to):
        return (n, f"https://{host}/", "".join(f'<a href="//{t}/x">' for t in to))

    pages = [page(0, "www.net.com", ["c0.org"])] + [page(n + 1, f"c{n}.org", [f"c{n + 1}.org"]) for n in range(22)]
    pages += [(100, "https://bad.net/es/x", ""), page(101, "feeder.org", ["bad.net", "c0.org"]), page(102, "loop.org", ["feeder.org"]), page(103, "feeder.org", ["loop.org"])]
    pages += [page(200, "alone.org", []), (201, None, "//c1.org"), (202, "no host", None)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    judged = judge_urls(frame, "page_id", "url", "html", RULES)
    rows = judged.collect()
    by_host = {r["host"]: r for r in rows}
    assert by_host["c21.org"]["trust"] > 0 and by_host["loop.org"]["verdict"] == "block"
    own = duckdb.connect()
    own.register("pages", frame.toPandas())
    expected = own.execute(SQL["op6_url_filters"]).fetchall()
    assert sorted(map(str, expected)) == sorted(str((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])) for r in rows)
