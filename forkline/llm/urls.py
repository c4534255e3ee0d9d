"""URL filters: rules by host and path, else logistic regression on hashed character n-grams.

The regression reads the n-grams of host and path, hashed into a fixed number of weights, and is fitted
to the labelled table below, which a fixed rule makes from words of both kinds.  Held out in turn,
its urls are told apart in nine cases of ten or more (a test measures it); words of neither list say nothing.

Cases: a null url or one without :// has an empty host and path, so no rule fits and the
verdict is allow; urls are read whole; repeated rows get equal results; an empty table gives no
rows; other columns are not read.
"""

import random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from forkline.llm.common import strings

# Fixed values: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

# The labelled table is made by a rule from words of both kinds, names that say nothing, and forms of hosts and paths.
BLOCK_WORDS = """casino poker bets betting slots jackpot lottery roulette pills viagra pharma steroids adult xxx porn sex escort nude
ads adserver tracker banner popup malware crack keygen warez torrent phishing spam linkfarm payday loans replica""".split()
ALLOW_WORDS = """news library museum school university garden weather travel music recipes health sports history science book
film city council art theatre cooking nature cinema magazine journal college radio forum docs guide review craft""".split()
BLOCK_PATHS = "play join odds buy order watch live click prize claim deal download".split()
ALLOW_PATHS = "about article paper page list index post chapter contact events topic archive".split()
PLAIN = "free best online my the new top one web shop daily first".split()
# common pieces of English words
SYLLABLES = "the ing tion er on an re th st en at es or ou le ly sh wh ble nt ed ra nd ti in he ar al".split()
EACH = 240


def labelled(each=EACH, seed=3):
    """(url, 1 for block or 0 for allow), `each` of both: hosts from a word of the kind, or, among those allowed, from
    syllables only; paths of the kind or of neither."""
    rnd = random.Random(seed)
    out = []
    for k in range(2 * each):
        blocked = k % 2 == 0
        words, paths = (BLOCK_WORDS, BLOCK_PATHS) if blocked else (ALLOW_WORDS, ALLOW_PATHS)
        name = "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(2, 4)))
        word = rnd.choice(words) if blocked or rnd.random() < 0.5 else name
        host = rnd.choice([f"{word}", f"{rnd.choice(PLAIN)}-{word}", f"{word}-{rnd.choice(PLAIN)}", f"{word}-{name}", f"{word}{rnd.choice(PLAIN)}"])
        front = rnd.choice(["", "", "www.", "m.", "blog."])
        path = rnd.choice(["", f"/{rnd.choice(['en', 'fr', 'de', 'es'])}/{rnd.randint(1, 999)}", f"/{rnd.choice(paths)}",
                           f"/{rnd.choice(paths)}/{rnd.randint(1, 99)}.html", f"/{rnd.randint(1, 999)}/"])
        out.append((f"http{rnd.choice(['', 's'])}://{front}{host}.example.{rnd.choice(['com', 'net', 'org'])}{path}", int(blocked)))
    return out


BITS = 14
GRAMS = (3, 4, 5)


def parts(url):
    """(host, path) by the columns' definition."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return host, path[:end]


def rule_of(host, path, rules=RULES):
    """The longest rule that fits, with its verdict, or (None, None)."""
    fit = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def grams(host, path):
    """Places of the n-grams of host and path; those of a path count apart from those of a host."""
    out = {0}
    for name, text in (("h", f".{host}."), ("p", path)):
        for n in GRAMS:
            out.update(1 + xxhash.xxh3_64_intdigest(f"{name}{text[i:i + n]}") % ((1 << BITS) - 1)
                       for i in range(len(text) - n + 1))
    return sorted(out)


def fit(table=None, rounds=1500, rate=0.5, penalty=1e-4):
    """Weights by gradient descent on the mean log loss with a quadratic penalty."""
    table = labelled() if table is None else table
    rows = [grams(*parts(u)) for u, _ in table]
    y = np.array([v for _, v in table], float)
    places, at = np.unique(np.concatenate(rows), return_inverse=True)
    x = np.zeros((len(rows), len(places)))
    owner = np.repeat(np.arange(len(rows)), [len(g) for g in rows])
    x[owner, at] = 1 / np.sqrt(np.array([len(g) for g in rows]))[owner]
    # the weights stay a mixture of the rows, so the steps go over the mixture
    alike, mixture = x @ x.T, np.zeros(len(rows))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-alike @ mixture))
        mixture -= rate * 10 * ((p - y) / len(y) + penalty * mixture)
    w = np.zeros(1 << BITS)
    w[places] = x.T @ mixture
    return w


def probability(weights, host, path):
    """How likely a url is to be blocked; 0 without a host, of which the model has learned nothing."""
    if not host:
        return 0.0
    g = grams(host, path)
    return float(1 / (1 + np.exp(-weights[g].sum() / np.sqrt(len(g)))))


def judge(pages, rules=RULES, weights=None, page_id="page_id", url="url", threshold=0.5):
    """page_id, host, path, rule, verdict and the model's probability of `block`."""
    weights = fit() if weights is None else weights

    def run(batches):
        known = {}
        for pdf in batches:
            rows = []
            for u in strings(pdf["url"]):
                host, path = parts(u)
                rule, verdict = rule_of(host, path, rules)
                key = (host, path)
                if key not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[key] = probability(weights, host, path)
                p = known[key]
                rows.append((host, path, rule, verdict or ("block" if p >= threshold else "allow"), p))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "block_probability"])
            out.insert(0, "page_id", pdf["page_id"].to_numpy())
            yield out

    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    return p.mapInPandas(run, "page_id long, host string, path string, rule string, verdict string, block_probability double")
