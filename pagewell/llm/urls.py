"""URL filters: rules first, then logistic regression on hashed character n-grams.

The regression is trained in numpy on a small labelled table of urls, from
n-grams of the whole host and path kept apart; without a known one the score is one half. A rule names a host and the beginning of a
path; it fits the host and all its subdomains, and the longest that fits wins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewell.llm.common import ascii_lower

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
EPOCHS = 300
BLOCK_FROM = 0.5
# Most rules that every task holds; more are joined. Most labelled urls the driver trains on; more are an error.
HELD_RULES, MOST_LABELS = 100_000, 100_000

# --- fixed values: rules (host, path, verdict) and the labelled urls ----------
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
# Kinds of sites that url lists commonly block (gambling, pills, adult, adverts and
# tracking, spam, loans and coins, phishing, stolen software and malware) and kinds they don't. Host
# endings come equally often in both, so that they say little.
BLOCKED_URLS = """
www.royalcasino777.com/slots/bonus onlinecasinos.org/no-deposit livecasino-games.net/play casinobonus.com/vegas jackpotslots.org/spins
sportsbetting24.info/odds bet-now.net/football-bets bestbets.com/tips betting-odds.de/live pokerstack.net/tournament texas-poker.org/join
lottery-winner.biz/claim lottowin.com/ticket roulettewheel.org/play
buy-viagra-online.net/order cialis-discount.com/buy cheapmeds.org/pharmacy pillstore.info/no-prescription discount-pills.net/cart
onlinepharmacy24.com/xanax weightlosspills.de/offer slim-diet-pills.net/miracle
freeporn.org/videos pornvideos.biz/watch adultdating.com/meet adult-chat.org/cams sexcams.net/live hotsexgirls.com/gallery
xxxmovies.org/hd nude-cams.info/join escortservice.net/city adultfriends.com/signup
adserver.de/banner/click ads.clicknetwork.net/serve adtracker.org/pixel tracking.pixelcount.biz/t.gif banner-ads.com/popup popads.org/redirect
doubleads.net/ads/serve clicktracker.com/track/click affiliate-track.org/offer adclick.info/out adsync.net/cookie trackpixel.com/ads
spamlinks.de/links backlinkfarm.net/seo buybacklinks.org/cheap link-exchange.biz/spam articlespinner.com/content seo-spam.org/pages
cheapfollowers.net/buy freelikes.com/spam bulkmailer.org/spam-list
paydayloans24.info/apply fastcashloans.net/approved cheaploans.com/credit crypto-doubler.de/free-coins bitcoingiveaway.net/claim
freegiftcard.org/survey free-iphone-winner.biz/claim freeprizes.com/spin getrichquick.org/money makemoneyfast.net/easy
secure-login-verify.com/account paypa1-login.org/update account-verify.info/password appleid-locked.net/signin
crackedsoftware.com/keygen warez-download.de/crack freekeygen.net/serial torrentcracks.org/full free-download-exe.biz/setup.exe
malware-cleaner.com/download virus-alert.org/scan fakepc-support.net/call replica-watches.com/cheap cheap-handbags.org/replica
""".split()
ALLOWED_URLS = """
www.nationalmuseum.com/exhibitions/roman-history citylibrary.org/catalog/12 www.stateuniversity.net/faculty/law dailyherald.com/world/2019/election
weatherservice.org/forecast/north www.cityhospital.info/visitors publicradio.net/programs/science botanicgarden.com/plants/roses
encyclopedia.de/wiki/River dictionary.net/entry/water openlectures.org/course/mathematics history-society.biz/articles/cathedral
www.gardeninghints.com/vegetables homecooking.org/recipes/bread kitchentable.net/soups/onion travelnotes.com/paris/museums hikingtrails.org/mountain
localnews.info/council/minutes tribune.net/opinion/letters theguardianpost.com/environment morningpress.de/culture/theatre
programming.net/tutorial/functions docs.framework.org/reference/api developers.biz/guides/intro opensource.com/projects
chessclub.org/openings runningclub.net/results/marathon football-league.com/tables swimming.org/training
parenting.info/school/homework teachers.net/lessons/reading kindergarten.com/songs childrenstories.de/tales
cinema-review.net/interview filmfestival.org/program theatre.biz/season concerthall.com/orchestra musiclessons.org/piano
government.net/forms/tax parliament.com/debates citycouncil.org/planning courts.info/decisions census.net/tables
physics.com/papers/relativity astronomy.de/stars/orion chemistry.net/notes/reaction biology.org/cells medicaljournal.biz/article/heart
oceanresearch.com/station antarctica.org/expedition geology.net/minerals archive.com/details/letters gutenberg.org/authors
railway.info/timetable airport.net/departures ferries.com/islands hotel-review.de/rooms maps.net/region/north
bookshop.org/fiction/novels publisher.biz/authors poetry.com/sonnets literature.org/reading writers.net/interview
woodworking.com/joints knitting.org/patterns photography.info/lenses painting.net/technique pottery.com/glaze
farmers.de/harvest weather-station.net/rain forestry.org/trees birdwatching.biz/heron fishing.com/rivers
bank.org/branches insurance.net/information consumer.com/tests energy.org/efficiency water.info/supply
blog.thoughtful.net/2014/03/other-things another.blogger.com/notes/on-the-road www.anderson.de/thanks m.southern.net/stories/the-return
forum.motorists.org/thread/5512 community.gardeners.biz/question/29 answers.teachers.com/7817 mailing.developers.org/thread
church.net/sermons synagogue.com/calendar monastery.org/visit charity.info/donate foundation.net/reports redcross.com/volunteers
language.de/grammar/verbs spanish.net/lecciones/verbos francais.org/histoire deutsch.biz/geschichte/berlin noticias.com/mundo
constitution.org/amendments treaties.net/nations elections.com/results statistics.org/population economics.info/lecture
engineering.net/bridges electronics.com/resistors mechanics.de/engines architecture.net/houses interior.org/furniture
""".split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (``A-Z`` lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    # `find` patterns anchored at the start; (?s) so that line breaks are ordinary.
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _grams(kind: str, text: str) -> list[int]:
    framed = f"^{text}$"
    return [zlib.crc32(f"{kind}{framed[i:i + n]}".encode("utf-8", "replace")) % BUCKETS for n in GRAMS for i in range(len(framed) - n + 1)]


def _features(host: str, path: str) -> np.ndarray:
    return np.unique(np.array(_grams("h", host) + _grams("p", path), np.int64))


class UrlClassifier:
    """Logistic regression with an L2 penalty and no intercept, by gradient descent on all rows at once."""

    def __init__(self, urls: list[str], blocked: list[int], epochs: int = EPOCHS):
        rows = [_features(*(url.split("/", 1)[0].lower(), "/" + url.partition("/")[2])) for url in urls]
        y = np.array(blocked, float)
        self.weight = np.zeros(BUCKETS)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        column = np.concatenate(rows) if rows else np.zeros(0, int)
        scale = (1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=len(rows)))))
        for _ in range(epochs if len(rows) else 0):
            z = scale * np.bincount(row, self.weight[column], len(rows))
            g = (y - 1 / (1 + np.exp(-z)))
            self.weight += 0.5 * (np.bincount(column, (g * scale)[row], BUCKETS) - 0.01 * self.weight)

    def score(self, host: str, path: str) -> float:
        f = _features(host, path)
        z = self.weight[f].sum() / np.sqrt(max(1, len(f)))
        return float(1 / (1 + np.exp(-z)))


class RuleTable:
    """Rules by host; looked up for every parent domain of a host."""

    def __init__(self, rules):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host, []).append((path, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits, as ``host + path``, and its verdict. Of equally
        long ones the longer host, then the first in order, wins."""
        best, labels = None, host.split(".")
        for k in range(len(labels)):
            parent = ".".join(labels[k:])
            for start, verdict in self.by_host.get(parent, ()):
                if path.startswith(start) and (best is None or len(parent) + len(start) > len(best[0])):
                    best = (parent + start, verdict)
        return best or (None, None)


def rules_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` of the urls (``host, path``, distinct) that a rule fits, by
    joins: what ``RuleTable.find`` finds for any number of rules. ``rules`` has ``host, path,
    verdict`` and may have ``place``, their order."""
    place = F.col("place") if "place" in rules.columns else F.lit(0)
    table = rules.select(F.col("host").alias("_parent"), F.col("path").alias("_start"), F.col("verdict").alias("_verdict"), place.alias("_place"))
    labels = F.split("host", "[.]", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    met = urls.select("host", "path", F.explode(parents).alias("_parent")).join(table, "_parent").where(F.startswith("path", "_start"))
    rule = F.concat("_parent", "_start")
    # Without an order of their own, equal rules go by their verdict.
    rank = F.struct(F.length(rule), F.length("_parent"), -F.col("_place"), "_verdict")
    best = F.max_by(F.struct(rule.alias("rule"), F.col("_verdict").alias("rule_verdict")), rank)
    return met.groupBy("host", "path").agg(best.alias("_best")).select("host", "path", "_best.*")


def label_table(spark) -> DataFrame:
    rows = [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]
    return spark.createDataFrame(rows, "url string, blocked int")


def judge_urls(pages: DataFrame, rules=None, labels: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per page row.

    ``rules`` are ``(host, path, verdict)``, or a table of these columns; a table, and a list
    of more than ``HELD_RULES``, is joined to the distinct urls. ``labels`` has ``url`` (without
    scheme) and ``blocked`` (0 or 1; rows with nulls are left out). A url that is null or has no ``://`` has
    an empty host and path, fits no rule and is judged by the regression.
    ``score`` is the regression's, also where a rule decides. Without labels it is one half and blocks nothing.
    Repeated rows are judged alike; no pages give no rows; other columns are not read.
    """
    spark = pages.sparkSession
    rules = RULES if rules is None else rules
    labels = label_table(spark) if labels is None else labels
    if not isinstance(rules, DataFrame) and len(rules) > HELD_RULES:
        rows = [(*rule, place) for place, rule in enumerate(rules)]
        rules = spark.createDataFrame(rows, "host string, path string, verdict string, place long")
    known = labels.where(F.col("url").isNotNull() & F.col("blocked").isin(0, 1)).select("url", "blocked").limit(MOST_LABELS + 1).collect()
    if len(known) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled urls")
    known = sorted((r.url, r.blocked) for r in known)
    joined = isinstance(rules, DataFrame)
    table = RuleTable(() if joined else rules)
    model = UrlClassifier([u for u, _ in known], [b for _, b in known])

    def judge(batches):
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [table.find(h, p) for h, p in zip(hosts, paths)]
            scores = [model.score(h, p) for h, p in zip(hosts, paths)]
            verdicts = [v or ("block" if s > BLOCK_FROM else "allow") for (_, v), s in zip(found, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([r for r, _ in found], pa.string()), pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                ["page_id", "host", "path", "rule", "verdict", "score"])

    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    judged = cut.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, score double")
    if not joined:
        return judged
    fits = rules_of(cut.select("host", "path").distinct(), rules)
    both = judged.drop("rule").join(fits, ["host", "path"], "left")
    return both.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "verdict").alias("verdict"), "score")
