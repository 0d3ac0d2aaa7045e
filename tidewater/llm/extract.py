"""HTML extraction: a bidirectional LSTM in numpy labels the blocks of a page."""

from __future__ import annotations

import functools
import html
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import table

PATHS, WORDS, SIZES, HIDDEN = 256, 128, 10, 16     # hashed features, lengths and units a direction
FEATURES = PATHS + WORDS + SIZES
SAMPLE = 300        # pages the labeller is fitted on: smallest hashes of page_id
SAMPLE_CHARS, SAMPLE_BLOCKS = 200_000, 40       # read of such a page; blocks in a row of one step
STEPS, BATCH, RATE = 250, 16, 0.15

# Dropped by name: comments, scripts and styles (up to the end of the page if never
# closed), closed noscript and template elements, titles (their text alone if not closed).
ATTRS = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"      # a quoted value may hold >
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<(script|style)(?![\w-]){ATTRS}>.*?(?:</\1\s*>|$)"
                   rf"|<(noscript|template)(?![\w-]){ATTRS}>(?:(?!<\2(?![\w-])).)*?</\2\s*>"
                   rf"|<(title)(?![\w-]){ATTRS}>(?:(?:(?!<(?:/head|body|title|meta|link|script|style)(?![\w-])).)*?</title\s*>|[^<]*)"
                   rf"|<(/?)([a-zA-Z][\w-]*)({ATTRS})(?:>|$)|<[!?][^>]*(?:>|$)", re.S | re.I)
ATTR = re.compile(r"([^\s=>\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAMING = ("class", "id", "role")
# Elements that stay inside a block, elements without an end tag, and
# names of page parts that are not the article.
INLINE = set("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
OUTSIDE = set("nav header footer aside form button select menu dialog sidebar ad ads advert advertisement banner promo "
              "sponsored cookie notice consent comments comment replies related share social newsletter breadcrumb".split())

# Words that adverts, notices, forms and comment parts are made of.
WORDING = set("advertisement advert sponsored promoted buy shop sale discount offer deal deals price free shipping order now limited "
              "subscribe newsletter signup sign login register account password email cookie cookies consent accept privacy policy "
              "terms copyright rights reserved share tweet follow like comment comments reply replied related trending read more click "
              "here menu home contact about search skip "
              "publicidad anuncio compra oferta ofertas descuento gratis suscribete suscríbete boletín aceptar privacidad derechos "
              "reservados compartir comentario comentarios responder iniciar sesión inicio contacto "
              "publicité annonce achetez soldes gratuit abonnez infolettre accepter confidentialité droits réservés partager "
              "commentaires répondre connexion accueil "
              "werbung anzeige kaufen angebot rabatt kostenlos abonnieren akzeptieren datenschutz rechte vorbehalten teilen "
              "kommentare antworten anmelden startseite kontakt".split())


def leaves(page):
    """Leaf blocks (tag path words, text) of a page in order; tags, scripts, styles
    and comments are gone, entities decoded, white space single."""
    out, stack, text, pos = [], [], [], 0

    def flush():
        t = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if t:
            out.append(([w for _, ws in stack for w in ws], t))

    for m in TOKEN.finditer(page):
        text.append(page[pos:m.start()])
        pos = m.end()
        name = (m.group(5) or "").lower()
        if not name:
            if m.group(1) or m.group(2) or m.group(3):
                flush()
            continue
        if name in INLINE:
            continue
        flush()
        if name in ("head", "noscript", "template"):    # may lack an end: no element of the page lies in them
            continue
        if m.group(4):
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                del stack[at:]
        elif name not in VOID:
            if name in ("p", "li", "td", "tr", "option") and stack and stack[-1][0] == name:
                stack.pop()
            found = " ".join(x for n, *v in ATTR.findall(m.group(6)) if n.lower() in NAMING for x in v)
            stack.append((name, [name, *re.findall(r"[a-z]+", found.lower())]))
    text.append(page[pos:])
    flush()
    return out


IDS: dict[str, int] = {}


def word_id(w):
    """Hashed feature of a word, cached for common ones (the cache is emptied when full)."""
    got = IDS.get(w)
    if got is None:
        if len(IDS) > 200_000:
            IDS.clear()
        got = IDS[w] = zlib.crc32(w.encode("utf-8", "replace")) % WORDS
    return got


def tokens(text):
    return re.findall(r"\w+", text.lower())


def worded(texts):
    """A row for each text: all its words, hashed and counted, at length 2, and the
    power of two of their number."""
    found = [[word_id(w) for w in tokens(text)] for text in texts]
    lens = np.array([len(f) for f in found])
    at = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(lens.sum()))
    n = np.bincount(at + np.repeat(np.arange(len(texts)) * WORDS, lens), minlength=len(texts) * WORDS)
    n = n.reshape(-1, WORDS).astype(np.float32)
    out = np.zeros((len(texts), WORDS + SIZES), np.float32)
    out[:, :WORDS] = n * (2 / np.maximum(1, np.sqrt((n * n).sum(1, keepdims=True))))
    out[np.arange(len(texts)), WORDS + np.minimum(np.ceil(np.log2(lens + 1)).astype(int), SIZES - 1)] = 1
    return out


@functools.lru_cache(10_000)
def pathed(path):
    return np.bincount([zlib.crc32(w.encode()) % PATHS for w in path], minlength=PATHS).astype(np.float32)


def matrix(blocks, rows=None):
    """One row a block: hashed path words, then its text (rows, if they are known)."""
    rows = worded([text for _, text in blocks]) if rows is None else rows
    return np.concatenate([np.array([pathed(tuple(path)) for path, _ in blocks]), rows], 1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def cell(z, c):
    """One LSTM step from gate inputs (rows x 4 HIDDEN): (gates i f o, g, new c, new h)."""
    s = sigmoid(z[:, :3 * HIDDEN])
    i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
    g = np.tanh(z[:, 3 * HIDDEN:])
    c = f * c + i * g
    return (i, f, o), g, c, o * np.tanh(c)


def forward(x, w, u, b):
    """LSTM over the steps of x (steps x pages x features); hidden states and what backward needs."""
    h, c, kept = *np.zeros((2, x.shape[1], HIDDEN), np.float32), []
    pre = x @ w + b
    for t in range(len(x)):
        was, before = c, h
        gates, g, c, h = cell(pre[t] + h @ u, c)
        kept.append((*gates, g, was, c, before, h))
    return np.array([k[-1] for k in kept]), kept


def backward(x, u, kept, dh):
    dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    du, nh, nc = np.zeros_like(u), *np.zeros((2, *dh.shape[1:]), np.float32)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, was, c, before, _ = kept[t]
        d, tc = dh[t] + nh, np.tanh(c)
        dc = nc + d * o * (1 - tc * tc)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * was * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        nh, nc = dz[t] @ u.T, dc * f
        du += before.T @ dz[t]
    flat = dz.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, FEATURES).T @ flat, du, flat.sum(0)


def predict(pages, p):
    """For each page (a list of blocks) whether its blocks are main text. Pages advance
    together, one block a step in each direction, so no page is padded; the gate inputs,
    512 bytes a block, are all that is held beside the blocks."""
    blocks = [b for page in pages for b in page]
    lens = np.array([len(page) for page in pages])
    begin = np.cumsum(lens) - lens
    order = np.argsort(-lens, kind="stable")
    out = np.full(len(blocks), float(p[7]))
    w, b = np.hstack([p[0], p[3]]).astype(np.float32), np.hstack([p[2], p[5]]).astype(np.float32)
    pre = np.empty((len(blocks), 8 * HIDDEN), np.float32)
    for i in range(0, len(blocks), 2048):
        pre[i:i + 2048] = matrix(blocks[i:i + 2048]) @ w + b
    for back in (0, 1):
        u, v = p[4 if back else 1], p[6][back * HIDDEN:(back + 1) * HIDDEN]
        h, c = np.zeros((len(pages), HIDDEN)), np.zeros((len(pages), HIDDEN))
        live = len(pages)
        for t in range(int(lens.max(initial=0))):
            while lens[order[live - 1]] <= t:
                live -= 1
            at = begin[order[:live]] + (lens[order[:live]] - 1 - t if back else t)
            _, _, c, h = cell(pre[at, back * 4 * HIDDEN:(back + 1) * 4 * HIDDEN] + h[:live] @ u, c[:live])
            out[at] += h @ v
    return [out[i:i + n] >= 0 for i, n in zip(begin, lens)]


def taught(page):
    """(block, label, weight) of each block of a page. The markup is the teacher: with an article,
    the blocks in it whose path names no other part are main text. Without one, named
    parts and blocks of WORDING are not, headings, paragraphs and blocks of 15 words are,
    and what else there is stays open (weight 0) for words and neighbours to decide."""
    whole = any("article" in path for path, _ in page)
    out = []
    for path, text in page:
        found = tokens(text)
        named = bool(OUTSIDE & set(path))
        if whole:
            out.append(((path, text), not named and "article" in path, 1.0))
        else:
            notice = 4 * sum(w in WORDING for w in found) >= len(found)
            sure = named or notice or len(found) >= 15 or path[-1:] in (["h1"], ["h2"], ["h3"], ["p"])
            out.append(((path, text), not named and not notice, float(sure)))
    return out


def varied(page, words, rng):
    """SAMPLE_BLOCKS blocks of a taught page, with parts put in and names taken away, so that words and
    neighbours carry the label too: named parts with any text; blocks of WORDING under
    plain elements, inside and outside the article; paragraphs that hold a few such
    words and stay; pages whose parts and article have no telling names."""
    at = int(rng.integers(max(1, len(page) - SAMPLE_BLOCKS + 1)))
    page = page[at:at + SAMPLE_BLOCKS]
    blocks, y, weight = map(list, zip(*page))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def put(path, text, label):
        at = int(rng.integers(len(blocks) + 1))
        blocks.insert(at, (path, text))
        y.insert(at, label)
        weight.insert(at, 1.0)

    def around():
        near = [p for p, _ in blocks if "article" in p and not OUTSIDE & set(p)]
        return ["html", "body", *pick([[], ["main"], ["div"], ["main", "article"] if near else ["section"]])]

    if rng.random() < 0.5:
        for _ in range(3):
            put([*around(), "div", pick(NAMES), "p"], pick(page)[0][1], False)
    if rng.random() < 0.6:
        for _ in range(3):
            n = int(rng.integers(2, 15))
            text = " ".join(pick(words) if rng.random() < 0.3 else pick(SEEDS) for _ in range(n))
            put([*around(), pick(["div", "p", "section", "ul"])], text, False)
    if rng.random() < 0.5:
        for i, (path, text) in enumerate(blocks):
            if y[i] and weight[i] and len(text) > 100 and rng.random() < 0.3:
                blocks[i] = (path, f"{text} {pick(SEEDS)} {pick(SEEDS)}")
    wrap = pick([[], ["main"], ["div"], ["section"], ["div", "main"]])
    blocks = [([*path[:2], *wrap, *path[2:]], text) for path, text in blocks]
    if rng.random() < 0.4:
        blocks = [([w for w in path if w not in OUTSIDE and w not in ("article", "main", "section")], text)
                  for path, text in blocks]
    else:   # where names tell, they do so for text of any kind and length
        for i, (path, text) in enumerate(blocks):
            if "article" in path and weight[i] and rng.random() < 0.15:
                some = [f"w{int(rng.integers(100_000))}" for _ in range(int(rng.integers(1, 4)))]
                blocks[i] = (path, " ".join(some * int(2 ** rng.uniform(0, 9))))
    return blocks, y, weight


NAMES, SEEDS = sorted(OUTSIDE), sorted(WORDING)


def train(pages):
    """Fit by Adagrad on varied pages, BATCH of them a step."""
    rng = np.random.default_rng(5)
    words = [w for page in pages for _, text in page[:20] for w in text.split()[:20]]
    pages = [taught(page) for page in pages if page]
    seen = functools.lru_cache(20_000)(lambda text: worded([text])[0])
    shapes = [(FEATURES, 4 * HIDDEN), (HIDDEN, 4 * HIDDEN), (4 * HIDDEN,)] * 2 + [(2 * HIDDEN,), ()]
    p = [rng.normal(0, 0.1, s).astype(np.float32) for s in shapes[:-1]] + [np.float32(0)]
    memory = [np.full(s, 1e-4, np.float32) for s in shapes]
    for _ in range(STEPS if pages else 0):
        made = [varied(pages[int(i)], words, rng) for i in rng.integers(len(pages), size=BATCH)]
        steps = max(len(m[0]) for m in made)
        x, back = np.zeros((2, steps, BATCH, FEATURES), np.float32)
        y, weight, turn = np.zeros((steps, BATCH)), np.zeros((steps, BATCH)), np.zeros((steps, BATCH), int)
        for k, (blocks, label, some) in enumerate(made):
            n = len(blocks)
            x[:n, k] = matrix(blocks, [seen(text) for _, text in blocks])
            back[:n, k] = x[:n, k][::-1]
            y[:n, k], weight[:n, k] = label, np.array(some) / n
            turn[:, k] = np.concatenate([np.arange(n)[::-1], np.arange(n, steps)])
        cols = np.arange(BATCH)
        a, ka = forward(x, *p[0:3])
        z, kz = forward(back, *p[3:6])
        h = np.concatenate([a, z[turn, cols]], 2)
        d = ((sigmoid(h @ p[6] + p[7]) - y) * weight / BATCH).astype(np.float32)
        dh = d[..., None] * p[6]
        grads = [*backward(x, p[1], ka, dh[..., :HIDDEN]), *backward(back, p[4], kz, dh[turn, cols][..., HIDDEN:]),
                 np.einsum("tbh,tb->h", h, d), d.sum()]
        for k, g in enumerate(grads):
            memory[k] = memory[k] + g * g
            p[k] = p[k] - RATE * g / np.sqrt(memory[k])
    return p


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(pages):
    """One row per page: page_id, url, text, n_chars. Null or empty html has an empty
    text; an empty table gives no rows; repeated rows give repeated results; columns
    of other names are not read. The labeller is fitted on SAMPLE pages (ids first, then
    their html; of rows of one page_id one), a page's whole text is read by it."""
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    ids = [r.page_id for r in pages.where("page_id IS NOT NULL AND html IS NOT NULL").select("page_id").distinct()
           .orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE).collect()]
    sample = (pages.where(F.col("page_id").isin(ids)).groupBy("page_id")
              .agg(F.min(F.substring("html", 1, SAMPLE_CHARS)).alias("html")).orderBy("page_id").collect()) if ids else []
    shared = spark.sparkContext.broadcast(train([leaves(r.html or "") for r in sample]))

    def run(batches):
        p = shared.value
        for b in batches:
            part, blocks = [], 0
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                part.append((row["page_id"], row["url"], leaves(row["html"] or "")))
                blocks += len(part[-1][2])
                if blocks >= 4096 or len(part) == 256 or at == b.num_rows - 1:
                    rows = []
                    for (page_id, url, found), keep in zip(part, predict([x[2] for x in part], p)):
                        text = " ".join(t for (_, t), k in zip(found, keep) if k)
                        rows.append({"page_id": page_id, "url": url, "text": text, "n_chars": len(text)})
                    yield pa.RecordBatch.from_pylist(rows, OUT)
                    part, blocks = [], 0

    return pages.mapInArrow(run, SCHEMA)


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def op8(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
