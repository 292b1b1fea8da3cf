"""The url regression on sites outside the labelled domains."""

import numpy as np

from pagewell.llm import urls

BLOCKED = """
www.casino-royal.com m.viagra-cheap.net/shop best-poker-bets.co.uk/bonus xxx-tube.tv/clip cheap-pills-online.biz/order
sex-chat-room.de www.payday-loan-fast.info/apply ads-track.io/banner.gif click-track.net/t free-slots-casino.eu/spin
porn-hub.xyz/v www.lotto-win.org/claim
""".split()
ALLOWED = """
www.city-library.com/catalog m.weather-today.net/berlin history-museum.co.uk/visit science-papers.org/notes travel-guide.de/paris
school-lessons.info/math www.music-concerts.eu/program garden-roses.net/en university-hospital.com/faculty books-review.org/77
www.bread-recipes.com nature-birds.io/photo
""".split()


def model():
    return urls.UrlClassifier([*urls.BLOCKED_URLS, *urls.ALLOWED_URLS], [1] * len(urls.BLOCKED_URLS) + [0] * len(urls.ALLOWED_URLS))


def test_urls_outside_the_labelled_domains():
    fitted = model()
    score = lambda url: fitted.score(url.split("/", 1)[0], "/" + url.partition("/")[2])
    right = [score(u) > urls.BLOCK_FROM for u in BLOCKED] + [score(u) <= urls.BLOCK_FROM for u in ALLOWED]
    assert np.mean(right) > 0.9
    # The site decides where the first label is the same.
    assert score("www.casino-royal.com") > score("www.city-library.com") + 0.2


def test_digits_of_the_path_are_features():
    fitted = urls.UrlClassifier(["a.com/p/777", "b.com/p/777", "a.com/p/123", "b.com/p/123"], [1, 1, 0, 0])
    assert fitted.score("c.com", "/p/777") > 0.6 > 0.4 > fitted.score("c.com", "/p/123")


def longest_rule(rules, host, path):
    """Every rule tried on a host and path."""
    best = None
    for place, (site, start, verdict) in enumerate(rules):
        if (host == site or host.endswith("." + site)) and path.startswith(start):
            rank = (len(site + start), len(site), -place)
            if best is None or rank > best[0]:
                best = (rank, site + start, verdict)
    return best[1:] if best else (None, None)


def test_rules_held_and_joined_by_brute_force(spark):
    rng = np.random.default_rng(3)
    sites = ["org", "com", "b.com", "a.b.com", "b.org", "xb.com", "", "com."]
    starts = ["", "/", "/a", "/a/", "/aa", "/a/b"]
    rules = [(sites[i], starts[j], v) for i, j, v in zip(rng.integers(0, 8, 30), rng.integers(0, 6, 30), rng.choice(["allow", "block"], 30))]
    hosts, paths = ["a.b.com", "b.com", "xb.com", "q.org", "b.org", "com", "net", "", "a..com", "com.", "long." * 500 + "b.com"], ["", "/", "/a", "/a/b/c", "/aab", "/a" * 5000]
    urls_ = [f"x://{h}{p}" for h in hosts for p in paths] * 2 + [None, "no scheme"]
    pages = spark.createDataFrame([(k, u, "q", "z") for k, u in enumerate(urls_)], "page_id long, url string, host string, rule string")
    table = urls.RuleTable(rules)
    rows = [(*rule, place) for place, rule in enumerate(rules)]
    held = urls.judge_urls(pages, rules)
    joined = urls.judge_urls(pages, spark.createDataFrame(rows, "host string, path string, verdict string, place long"))
    assert held.columns == joined.columns
    got = sorted(map(tuple, held.collect()))
    assert got == sorted(map(tuple, joined.collect())) and len(got) == len(urls_)
    for _, host, path, rule, verdict, score in got:
        want = longest_rule(rules, host, path)
        assert (rule, verdict) == (want if want[0] is not None else (None, "block" if score > urls.BLOCK_FROM else "allow"))
        assert table.find(host, path) == want
    assert {r[3] for r in got} > {None}


def test_more_rules_than_are_held(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "x://a.com/p"), (2, "x://b.org/")], "page_id long, url string")
    monkeypatch.setattr(urls, "HELD_RULES", 2)
    rules = [("com", "/", "allow"), ("a.com", "/p", "block"), ("a.com", "/p", "allow"), ("net", "", "block")]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert got[1] == ("a.com/p", "block") and got[2][0] is None


def test_no_labelled_host_is_one_of_the_test_tables(sf_dir):
    import pyarrow.parquet as pq

    hosts = {u.split("://")[-1].split("/")[0] for u in pq.read_table(f"{sf_dir}/pages.parquet", columns=["url"])["url"].to_pylist() if u}
    assert not hosts & {u.split("/")[0] for u in [*urls.BLOCKED_URLS, *urls.ALLOWED_URLS]}
