"""HTML text: the region against all intervals, feature counts against a plain walk, linear time, nothing else dropped."""

import random
import time
from collections import Counter

from cachescope.llm import htmltext as H

TAGS = ["p", "div", "article", "nav", "span", "b", "ul", "li", "header", "section", "form", "main", "h1", "td"]
NAMES = ["sidebar", "post", "comments", "menu-item", "entry", "review-form-related"]


def random_page(rng):
    out = ["<body>"] if rng.random() < 0.5 else []
    for _ in range(rng.randint(1, 40)):
        r = rng.random()
        if r < 0.35:
            out.append(f"<{rng.choice(TAGS)} class='{rng.choice(NAMES)}'>" if rng.random() < 0.4 else f"<{rng.choice(TAGS)}>")
        elif r < 0.6:
            out.append(f"</{rng.choice(TAGS)}>")
        else:
            out.append(" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))))
    return "".join(out)


def random_weights(rng):
    names = [f"t:{t}" for t in TAGS] + ["c:sidebar", "c:post", "c:entry", "c:menu"]
    return H.Weights({n: rng.uniform(-4, 4) for n in names if rng.random() < 0.6}, {t: -rng.uniform(0.05, 2) for t in TAGS})


def plain_score(block, weights):
    """Evidence of every feature of a block, element by element."""
    known = []
    for e in H._path(block.element):
        named = not e.marked or all(n in H.HINTS for n in e.names)
        known += [weights.feature(f, named) for f in e.adds]
    known += [weights.feature(f) for f in H._own_feature(block.element)]
    worst = min(known, default=H.WORD_SCORE)
    return worst if worst < 0 else max(known, default=H.WORD_SCORE)


def test_region_has_the_greatest_sum():
    rng = random.Random(11)
    for _ in range(300):
        page, weights = random_page(rng), random_weights(rng)
        blocks, _ = H.read_page(page)
        score = [plain_score(b, weights) for b in blocks]
        value = [s * len(b.words.split()) for s, b in zip(score, blocks)]
        gap = [sum(weights.tag(t) for t in b.before) for b in blocks]
        sums = {(i, j): sum(value[i:j]) + sum(gap[i + 1:j]) for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1)}
        best = max([0.0, *sums.values()])
        texts = {"\n\n".join(b.words for b, s in zip(blocks[i:j], score[i:j]) if s > 0)
                 for (i, j), v in sums.items() if v >= best - 1e-9} if best > 1e-9 else {""}
        assert H.extract_page(page, weights) in texts


def test_counts_equal_a_plain_walk():
    rng = random.Random(12)
    for _ in range(200):
        page = random_page(rng)
        got = {True: Counter(), False: Counter()}
        H._page_counts(page, got)
        want = {True: Counter(), False: Counter()}
        for b in H.read_page(page)[0]:
            for f in b.features:
                want[b.marked][f] += len(b.words.split())
            for t in b.before:
                want[b.marked][f"<{t.lstrip('/')}"] += 1
            want[b.marked]["#"] += len(b.words.split())
        assert all(+got[k] == +want[k] for k in got), page


def test_broken_pages_of_a_megabyte_take_seconds():
    weights = H.Weights({}, {})
    for unit in ("<font>a b ", "<div class=x>a ", "<p>a<b>", "</i>a <i>b ", "<svg><head>a ", "<li><div>a</p>"):
        page = "<body><article>" + unit * (1_000_000 // len(unit))
        start = time.time()
        H.extract_page(page, weights)
        H._page_counts(page, {True: Counter(), False: Counter()})
        assert time.time() - start < 25, unit


def test_nothing_else_is_dropped():
    weights = H.Weights({"t:p": 6.0}, {"p": -0.05})
    page = ("<body><nav>Home</nav><article><p>where <math><mi>x</mi></math> is <svg><text>y</text></svg></p><p hidden>one two</p>"
            "<p style='display: none'>three four</p><div class='review-form-related'><p>five six</p></div>"
            "<noscript><p>seven</p></noscript><object><p>eight</p></object><div class='comments'><p>Me too</p></div></article>"
            "<script>x</script></body>")
    assert H.extract_page(page, weights) == "where x is y\n\none two\n\nthree four\n\nfive six\n\nseven\n\neight"
