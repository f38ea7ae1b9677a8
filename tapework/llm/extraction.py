"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into its leaf blocks in order. Each block has features of its ancestors (tags, words of class, id and role) and of
its text; neighbouring blocks have a transition that knows whether they share their parent. The field is trained on
labelled pages by its exact likelihood, and pages are labelled by Viterbi.
"""

import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapework.llm.words import slices

#: Slots of the hashed features.
SLOTS = 1 << 14
#: Pages whose blocks a fit may use, layouts drawn from each, and blocks of a labelled page.
TRAIN_PAGES = 300
LAYOUTS = 6
TRAIN_BLOCKS = 150
#: Elements that start and end a block, that never hold text of the page, that have no end tag, and that
#: close an open paragraph of their own kind.
BLOCKS = frozenset("""address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody
    td tfoot th thead title tr ul caption textarea head""".split())
UNSEEN = frozenset("script style template noscript head title iframe object svg math canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ALIKE = {t: frozenset(s.split()) for t, s in {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}.items()}
#: Elements that end the search for an open element of the same kind.
SCOPES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "table tr", "th": "table tr", "option": "select"}
#: Elements outside of which a paragraph is not closed by a block inside.
_KEEPS_P = BLOCKS - {"br", "label", "button", "option", "select", "textarea"}


def _parts(value):
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value)]


class _Reader(HTMLParser):
    """Leaf blocks of a page in order. ``open`` counts the open tags, ``words`` the words of their class, id and role."""

    def __init__(self, labelled=False):
        super().__init__(convert_charrefs=True)
        self.labelled, self.blocks, self.stack, self.open, self.words = labelled, [], [], Counter(), Counter()
        self.unseen, self.text, self.linked, self.number = 0, [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            if tag in _KEEPS_P and self.open["p"]:
                self.close_tag("p")
            if tag in ALIKE:
                self.close_alike(tag)
        if tag in VOID:
            return
        self.number += 1
        named = [w for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label") for w in _parts(v[:200])]
        label = next((v for k, v in attrs if k == "data-main"), None) if self.labelled else None
        hidden = any(k == "hidden" or k == "style" and v and re.search(r"display\s*:\s*none", v) for k, v in attrs)
        self.stack.append((tag, named, self.number, label, hidden))
        self.open[tag] += 1
        self.words.update(named)
        self.unseen += tag in UNSEEN or hidden

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and tag not in UNSEEN:
            return
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag in UNSEEN:
            self.flush()
        if self.open[tag]:
            self.close_tag(tag)

    def close_tag(self, tag):
        while self.stack:
            name = self.drop()
            if name == tag:
                return

    def close_alike(self, tag):
        ends = SCOPES[tag].split()
        for i in range(len(self.stack) - 1, max(-1, len(self.stack) - 64), -1):
            name = self.stack[i][0]
            if name in ends:
                return
            if name in ALIKE[tag]:
                while len(self.stack) > i:
                    self.drop()
                return

    def drop(self):
        tag, named, _, _, hidden = self.stack.pop()
        self.open[tag] -= 1
        for w in named:
            self.words[w] -= 1
            if not self.words[w]:
                del self.words[w]
        self.unseen -= tag in UNSEEN or hidden
        return tag

    def handle_data(self, data):
        if not self.unseen:
            self.text.append(data)
            if self.open["a"]:
                self.linked += len(data)

    def flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                inner = [t for t, *_ in self.stack if t in BLOCKS]
                parent = next((n for t, _, n, _, _ in reversed(self.stack) if t in BLOCKS and t not in ("p", "li", "dd", "dt", "td", "th", "tr")), 0)
                self.blocks.append((text, [t for t, n in self.open.items() if n > 0], inner[-1] if inner else "", list(self.words), self.linked, parent,
                                    next((label for *_, label, _ in reversed(self.stack) if label is not None), None) if self.labelled else None))
            self.text, self.linked = [], 0


def blocks_of(html, labelled=False):
    """Leaf blocks (text, open tags, innermost block tag, class words, linked characters, parent, label) of a page."""
    reader = _Reader(labelled)
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def _slot(name, known={}):
    at = known.get(name)
    if at is None:
        at = zlib.crc32(name.encode("utf-8", "replace")) & (SLOTS - 1)
        if len(known) < 100_000:
            known[name] = at
    return at


def _band(x):
    return int(x).bit_length()


def features(blocks):
    """Slots of each block's features, and for each block 1 where it has the parent of the block before."""
    out, same = [], np.zeros(len(blocks), np.int64)
    longest = max((len(b[0]) for b in blocks), default=1)
    heads = 0
    for i, (text, tags, inner, named, linked, parent, _) in enumerate(blocks):
        words = text[:4000].split()
        n = len(words)
        links = round(4 * min(1.0, linked / len(text)))
        stops = sum(text.count(c) for c in ".!?")
        names = {f"t:{t}" for t in tags}
        names |= {f"c:{w}" for w in named}
        names |= {"bias", f"i:{inner}", f"n:{_band(n)}", f"l:{links}", f"s:{_band(stops)}", f"m:{_band(text.count(','))}",
                  f"r:{_band(16 * len(text) // longest)}", f"nl:{_band(n)}:{links}", f"il:{inner}:{links}", f"in:{inner}:{_band(n) > 3}",
                  f"p:{5 * i // len(blocks)}", f"h:{min(heads, 2)}", f"e:{text[-1] in '.!?:;…»”)'}", f"y:{'©' in text}", f"w:{round(len(text) / n) > 8}"}
        if n <= 12:
            names |= {f"w:{w.strip('.,:;!?()[]').lower()}" for w in words}
        else:
            names |= {f"b:{w.strip('.,:;!?()[]').lower()}" for w in words[:3]}
        heads += inner == "h1"
        out.append([_slot(x) for x in names])
        same[i] = i > 0 and blocks[i - 1][5] == parent
    return out, same


class Field:
    """Weights of a two-label field: a row a slot, and for each kind of neighbourhood a table of transitions."""

    def __init__(self, weights=None, moves=None):
        self.weights = np.zeros((SLOTS, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2, 2)) if moves is None else moves

    def scores(self, slots):
        """(blocks, 2) from the slots of each block."""
        if not slots:
            return np.zeros((0, 2))
        sizes = np.array([len(s) for s in slots])
        flat = np.concatenate([np.asarray(s, np.int64) for s in slots])
        return np.add.reduceat(self.weights[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]))

    def viterbi(self, scores, same):
        """Best label of every block."""
        n = len(scores)
        if not n:
            return np.zeros(0, np.int64)
        (a, b), back = scores[0].tolist(), []
        moves, rows, kinds = self.moves.tolist(), scores.tolist(), same.tolist()
        for t in range(1, n):
            (m00, m01), (m10, m11) = moves[kinds[t]]
            p0, p1 = a + m00 >= b + m10, a + m01 >= b + m11
            a, b = (a + m00 if p0 else b + m10) + rows[t][0], (a + m01 if p1 else b + m11) + rows[t][1]
            back.append((0 if p0 else 1, 0 if p1 else 1))
        label = 0 if a >= b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1])

    def expectations(self, scores, same):
        """(log of the partition sum, label probabilities, pair probabilities) of one page, forwards and backwards."""
        n = len(scores)
        moves = self.moves[same]
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = scores[0]
        for t in range(1, n):
            ahead[t] = scores[t] + np.logaddexp(ahead[t - 1, 0] + moves[t, 0], ahead[t - 1, 1] + moves[t, 1])
        for t in range(n - 2, -1, -1):
            step = scores[t + 1] + behind[t + 1]
            behind[t] = np.logaddexp(moves[t + 1, :, 0] + step[0], moves[t + 1, :, 1] + step[1])
        total = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
        pairs = np.exp(ahead[:-1, :, None] + moves[1:] + (scores[1:] + behind[1:])[:, None, :] - total)
        return total, np.exp(ahead + behind - total), pairs

    def fit(self, pages, rounds=12, rate=0.3, decay=1e-4, seed=0):
        """Stochastic ascent (Adagrad) of the likelihood of ``pages``: (slots, same, labels) each."""
        order, rng = [p for p in pages if len(p[2])], random.Random(seed)
        seen_w, seen_m = np.full_like(self.weights, 1e-2), np.full_like(self.moves, 1e-2)
        for _ in range(rounds):
            rng.shuffle(order)
            for slots, same, labels in order:
                scores = self.scores(slots)
                _, single, pairs = self.expectations(scores, same)
                gap = -single
                gap[np.arange(len(labels)), labels] += 1
                flat = np.concatenate([np.asarray(s, np.int64) for s in slots])
                each = np.repeat(gap, [len(s) for s in slots], axis=0)
                used, place = np.unique(flat, return_inverse=True)
                grad = np.stack([np.bincount(place, each[:, k], len(used)) for k in (0, 1)], axis=1) - decay * self.weights[used]
                seen_w[used] += grad**2
                self.weights[used] += rate * grad / np.sqrt(seen_w[used])
                step = np.zeros_like(self.moves)
                np.add.at(step, same[1:], -pairs)
                np.add.at(step, (same[1:], labels[:-1], labels[1:]), 1)
                seen_m += step**2
                self.moves += rate * step / np.sqrt(seen_m)
        return self


# --- labelled pages ----------------------------------------------------------------------------------

#: Words that templates use for the parts of a page, by part; of "main" some templates use none.
PARTS = {
    "menu": ("nav|div.menu|ul.nav|div#navigation|div.navbar|div.breadcrumbs|div.top-links|ul.main-menu|div", "Home|About|Contact|News|Sport|Blog|Shop|Login|Help|Archive"),
    "header": ("header|div#header|div.site-header|div.masthead|div.banner-top|div.logo", "Daily|Site|Welcome|Sign in|Search|The"),
    "sidebar": ("aside|div.sidebar|div#side|div.widget|div.right-column|div.related|div.recommended|div.popular|section.more-stories", "Related|Popular|Most read|More|Recent posts|See also|Tags"),
    "notice": ("div.cookie|div.cookie-banner|div.consent|div.notice|div.alert|div.gdpr|div.popup|div.modal|div.message|section.notification|div.paywall|div.disclaimer",
               "We use cookies|Accept|Privacy|Notice|Please enable|This site uses|By continuing|Read our policy"),
    "advert": ("div.ad|div.ads|div.advert|div.advertisement|ins.adsbygoogle|div.sponsored|div.promo|div.banner|aside.ad|div#ad-slot", "Advertisement|Sponsored|Buy now|Offer|Sale|Shop now"),
    "form": ("form|div.newsletter|div.subscribe|div.search|form.signup|div.login|form.comment-form", "Subscribe|Your email|Search|Submit|Name|Send|Sign up|Post comment"),
    "comments": ("section.comments|div#comments|ol.commentlist|div.comment-list|div.disqus|div.replies|div.responses|section.discussion|div.reader-comments|article.comment",
                 "Comments|Reply|says|Report|Like|Anonymous|Responses|Leave a comment"),
    "share": ("div.share|div.social|ul.sharing|div.byline-links|div.tools|div.pagination|div.tags", "Share|Tweet|Email|Print|Follow us|Next|Previous"),
    "footer": ("footer|div#footer|div.footer|div.bottom|div.copyright|div.site-info|div.legal", "© 2020|All rights reserved|Terms|Imprint|Privacy policy|Contact us"),
}
MAIN = "article|main|article|div.content|div.post|div.entry-content|div.article-body|div.story|div#main|div#main-content|section.text|div.page|td.body|div|section|div.post-body"


def _element(rng, choice):
    name = rng.choice(choice.split("|"))
    tag, mark, value = re.match(r"(\w+)([.#]?)(.*)", name).groups()
    return tag, {".": f' class="{value}"', "#": f' id="{value}"', "": ""}[mark]


def _plain(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def layout(rng, main, others):
    """A labelled page: the texts ``main`` as its article, in a layout drawn by ``rng`` whose other parts hold fixed
    words and stretches of ``others``. Elements carry their label as ``data-main``."""
    def stretch(most):
        words = rng.choice(others).split() if others else ["text"]
        at = rng.randrange(len(words))
        return _plain(" ".join(words[at:at + rng.randint(2, most)]))

    def part(kind):
        choice, fixed = PARTS[kind]
        tag, mark = _element(rng, choice)
        items, fixed = [], fixed.split("|")
        if kind in ("menu", "share") or kind == "sidebar" and rng.random() < 0.6 or kind == "footer" and rng.random() < 0.3:
            texts = [rng.choice(fixed) if rng.random() < 0.4 else stretch(3 if kind != "sidebar" else 10) for _ in range(rng.randint(2, 8))]
            items = [f'<a href="/x">{t}</a>' for t in texts]
            inner = "".join(f"<li>{t}</li>" for t in items) if rng.random() < 0.7 else " | ".join(items)
            return f'<{tag}{mark} data-main="0"><ul>{inner}</ul></{tag}>' if "<li>" in inner else f'<{tag}{mark} data-main="0">{inner}</{tag}>'
        if kind == "comments":
            one, who = rng.choice(["div class=\"comment\"", "li", "p", "article class=\"comment\"", "div class=\"reply\"", "div"]), rng.choice(["<b>{}</b> says", "<cite>{}</cite>", "<span>{}</span>"])
            items = [f"<{one}>{who.format(stretch(2)) if rng.random() < 0.7 else ''}<p>{stretch(40)}</p>{rng.choice(['<a href=#>Reply</a>', ''])}</{one.split()[0]}>" for _ in range(rng.randint(1, 5))]
            head = f"<h3>{rng.choice(fixed)}</h3>" if rng.random() < 0.7 else ""
            return f'<{tag}{mark} data-main="0">{head}{"".join(items)}</{tag}>'
        if kind == "form":
            return f'<{tag}{mark} data-main="0"><label>{rng.choice(fixed)}</label><input type="text">{stretch(8) if rng.random() < 0.4 else ""}<button>{rng.choice(fixed)}</button></{tag}>'
        lead = "&copy; " if kind == "footer" and rng.random() < 0.5 else f"{rng.choice(fixed)} " if rng.random() < 0.5 else ""
        body = lead + stretch(30)
        if rng.random() < 0.5:
            body = f"<p>{body}</p>"
        if kind in ("notice", "sidebar") and rng.random() < 0.4:
            body = f"<h4>{rng.choice(fixed)}</h4>{body}"
        return f'<{tag}{mark} data-main="0">{body}</{tag}>'

    def some(kinds, chance):
        return [part(k) for k in kinds if rng.random() < chance]

    tag, mark = _element(rng, MAIN)
    body = []
    for i, text in enumerate(main):
        shown = _plain(text)
        if i == 0 and rng.random() < 0.8:
            shown = f"<h1>{shown}</h1>" if rng.random() < 0.8 else f"<header><h1>{shown}</h1></header>"
        elif len(text) < 80 and rng.random() < 0.3:
            shown = f"<h{rng.choice('234')}>{shown}</h2>"
        else:
            how = rng.random()
            words = shown.split(" ")
            if how < 0.2 and len(words) > 4 and "&" not in shown:
                at = rng.randrange(len(words))
                words[at] = f'<a href="/y">{words[at]}</a>' if rng.random() < 0.5 else f"<b>{words[at]}</b>"
                shown = " ".join(words)
            shown = rng.choices(["<p>{}</p>", "<p>{}", "<div>{}</div>", "{}<br><br>", "<li>{}</li>", "<blockquote>{}</blockquote>", "<figcaption>{}</figcaption>", "<pre>{}</pre>"],
                                [50, 10, 8, 8, 6, 5, 2, 1])[0].format(shown)
        body.append(shown)
        if rng.random() < 0.06:
            body.append(part(rng.choice(["advert", "share", "form", "sidebar"])))
    inner = "".join(body)
    before = some(["notice", "header", "menu", "advert", "share", "notice"], 0.45)
    after = some(["share", "sidebar", "comments", "form", "advert", "sidebar", "notice", "footer"], 0.5)
    if rng.random() < 0.3:
        rng.shuffle(before)
    page = f'<{tag}{mark} data-main="1">{inner}</{tag}>'
    if rng.random() < 0.3:
        page = f'<div class="{rng.choice(["wrapper", "container", "row", "site", "layout"])}">{"".join(before[2:])}{page}{"".join(after[:2])}</div>'
        before, after = before[:2], after[2:]
    return f"<html><head><title>{_plain(main[0][:60]) if main else ''}</title></head><body>{''.join(before)}{page}{''.join(after)}</body></html>"


def marked(html):
    """The main texts of a page that declares them, as ``article`` or ``main``, and its other texts."""
    main, others = [], []
    for text, tags, _, named, *_ in blocks_of(html):
        inside = ("article" in tags or "main" in tags) and not {"nav", "aside", "footer", "form", "button"} & set(tags) and not {"comment", "comments", "ad", "ads"} & set(named)
        (main if inside else others).append(text)
    return main, others


def labelled_pages(pages, rows=TRAIN_PAGES, layouts=LAYOUTS, seed=0):
    """Labelled pages as (slots, same, labels): from at most ``rows`` pages, the first by a hash of the id and one html an
    id, of those that declare their main text; each in ``layouts`` drawn layouts, of at most ``TRAIN_BLOCKS`` texts. Null pages, and pages that declare nothing, teach nothing."""
    given = pages.select(F.col("page_id").cast("long").alias("_id"), F.col("html").cast("string").alias("_html")).dropna()
    ids = given.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows)
    chosen = given.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min_by("_html", F.xxhash64("_html")).alias("_html"))

    def read(batches):
        for batch in batches:
            for at, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                main, others = (part[:TRAIN_BLOCKS] for part in marked(html))
                if main:
                    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([[t[:2000] for t in main]]), pa.array([[t[:400] for t in others]], pa.list_(pa.string()))], ["id", "main", "others"])

    found = chosen.mapInArrow(read, "id long, main array<string>, others array<string>").orderBy("id").toArrow().to_pylist()
    rng, stock = random.Random(seed), [t for r in found for t in (*r["others"], *r["main"][:2])]
    out = []
    for r in found:
        htmls = [layout(rng, r["main"][: rng.choice([2, 5, 12, TRAIN_BLOCKS])], stock) for _ in range(layouts)]
        for html in htmls:
            blocks = blocks_of(html, labelled=True)
            slots, same = features(blocks)
            out.append((slots, same, np.array([int(b[6] == "1") for b in blocks])))
    return out


def train(pages, **options):
    """A field fitted on ``labelled_pages``; without any of them it labels nothing as main."""
    return Field().fit(labelled_pages(pages, **options))


def main_text(html, field):
    """Texts of the blocks that the field labels as main, joined by one space."""
    blocks = blocks_of(html)
    slots, same = features(blocks)
    labels = field.viterbi(field.scores(slots), same)
    return " ".join(b[0] for b, y in zip(blocks, labels) if y)


def extract(pages, field):
    """Per page: ``page_id``, ``url``, ``text`` (main text, empty if none) and ``n_chars`` (its code points).

    Null and empty html give an empty text, broken or unended markup is read as far as it goes, pages of any length are
    read whole, repeated rows are read each, an empty table gives no rows, other columns stay out.
    """
    weights = pages.sparkSession.sparkContext.broadcast((field.weights, field.moves))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def run(batches):
        own = Field(*weights.value)
        for batch in batches:
            for part in slices(batch, 2):
                texts = [main_text(h, own) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
