"""Trains the block labeller from generated pages: python -m quayside.llm.html_training

Pages are drawn from many templates of invented words; what each block is follows from where the generator put it. Half of all parts,
articles too, have no telling tag or class, some pages are laid out in tables, and comments may stand inside the article, so the words,
shapes and order of blocks must tell. Run again with the same seed, it gives the same weights."""

from __future__ import annotations

import random

import numpy as np

from quayside.llm.html_blocks import HIDDEN, INPUT, MEASURES, PATH_BUCKETS, PATH_DIM, WEIGHTS, WORD_BUCKETS, WORD_DIM, Labeller, _path_keys, _word_bucket, blocks

SEED, PAGES, EPOCHS, BATCH, RATE = 11, 3500, 4, 32, 0.01

#: How pages of the web name their parts.
MAIN = ["article", "main", "div.content", "div.article-body", "div.post", "div.entry-content", "div#content", "section.story", "div.post-content", "main#main"]
NOISE = {
    "menu": ["nav", "div.menu", "ul.nav", "div.navbar", "nav.breadcrumb", "div#menu", "ul.pagination"],
    "header": ["header", "div.header", "div#masthead", "header.site-header", "div.topbar"],
    "footer": ["footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.colophon"],
    "side": ["aside", "div.sidebar", "div.widget", "div.related", "aside.sidebar", "div.recommended", "div.share", "div.social", "div.newsletter", "div.tags"],
    "notice": ["div.cookie", "div.notice", "div.alert", "div.consent", "div.banner", "div#cookie-banner", "div.disclaimer", "div.popup", "div.subscribe"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "aside.ad", "div.advertisement", "div#ad-top"],
    "form": ["form", "form.search", "form.login", "div.search", "form#subscribe"],
    "comments": ["div.comments", "section#comments", "div.comment", "ol.comment-list", "div.replies", "section.comments", "div#disqus", "ul.comments"],
}
TALK = {
    "menu": "home about contact products news next previous page".split(),
    "footer": "© copyright all rights reserved privacy terms ·".split(),
    "notice": "cookies accept we use this site agree policy notice subscribe".split(),
    "advert": "buy now sponsored offer sale free discount".split(),
    "form": "search name e-mail password submit login send".split(),
    "comments": "reply says posted comment thanks ago wrote agree post article comments".split(),
    "side": "related popular share tweet latest more".split(),
    "header": "menu login skip to".split(),
}
SYLLABLES = "an be ch de er ga ha in ka lo mi no or pa re sh ti ou ver zu é ción ung ble ion eau ß".split()


class Pages:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def words(self, n: int) -> str:
        r = self.r
        ws = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) + r.choice(["", "", "", "", ",", ".", "###", "%%%"]) for _ in range(n)]
        return " ".join(ws).capitalize()

    def sentence(self, n: int) -> str:
        return self.words(n).rstrip(",.") + self.r.choice([".", ".", ".", "", "!"])

    def wrap(self, spec: str, inner: str) -> str:
        tag, _, rest = spec.partition(".") if "." in spec else spec.partition("#")
        attr = "" if not rest else f' class="{rest}"' if "." in spec else f' id="{rest}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    def unnamed(self, *tags: str) -> str:
        """A tag without a class, or with one that tells nothing."""
        return self.r.choice(tags) + self.r.choice(["", ".", "#"]).replace(".", "." + self.words(1).strip(",.#%")).replace("#", "#" + self.words(1).strip(",.#%"))

    def noise(self, kind: str, bare: float = 0) -> str:
        """bare: how often nothing stands around it."""
        r = self.r
        named = r.random() < 0.5
        # Where no class tells what a part is, its words do.
        talk = lambda: " ".join(r.choice(TALK[kind]) for _ in range(r.randint(0 if named else 1, 3)))
        items = [f"{talk()} {self.words(r.randint(1, 12 if kind not in ('menu', 'form') else 3))}".strip() for _ in range(r.randint(1, 6))]
        mark = "\x01"
        if kind == "comments":
            items += [self.sentence(r.randint(5, 60)) for _ in range(r.randint(0, 4))]
            r.shuffle(items)
            if r.random() < 0.4:  # a name and a few words in one line
                items = [f"{self.words(1).strip(',.#%')}: {self.words(r.randint(1, 6))} {talk()} {self.words(r.randint(1, 6))}" for _ in items]
            elif not named:  # each reader's name before the words
                items = [y for x in items for y in (f"{self.words(r.randint(1, 2))} {r.choice(['says', 'wrote', '·', 'posted'])} {r.randint(1, 30)} {r.choice(['days ago', 'hours ago', 'May 2021', ':'])}", x)]
            if r.random() < 0.4:  # a name and a few words in one line
                items = [f"{self.words(1).strip(',.#%')}: {self.words(r.randint(1, 6))} {talk()} {self.words(r.randint(1, 6))}" for _ in items]
            elif not named:  # each reader's name before the words
                items = [y for x in items for y in (f"{self.words(r.randint(1, 2))} {r.choice(['says', 'wrote', '·', 'posted'])} {r.randint(1, 30)} {r.choice(['days ago', 'hours ago', 'May 2021', ':'])}", x)]
        body = ""
        style = r.randint(0, 3)
        if kind in ("menu", "footer", "header") and r.random() < 0.5:  # links in a row
            body = mark + r.choice([" ", " | ", " · "]).join(f'<a href="/{i}">{x}</a>' for i, x in enumerate(items))
        elif kind == "menu" or style == 0:
            body = "<ul>" + "".join(f'<li><a href="/{i}">{mark}{x}</a></li>' for i, x in enumerate(items)) + "</ul>"
        elif kind == "form":
            body = "".join(f"<label>{mark}{x}</label><input name=x>" for x in items) + f"<button>{mark}{self.words(1)}</button>"
        elif style == 1:
            body = "".join(f"<p>{mark}{x}</p>" for x in items)
        elif style == 2:
            head = self.words(2) if named else f"{r.choice(['', '3 ', '12 '])}{r.choice(TALK[kind]).capitalize()}"
            body = (f"<h3>{mark}{head}</h3>" if r.random() < 0.5 else "") + "".join(f"<div>{mark}{x}</div>" for x in items)
        else:
            body = mark + " ".join(items)
        if kind == "comments" and style in (1, 3) and not named:
            body = f"<h2>{mark}{r.choice(['Comments', 'Reader comments', 'Responses', 'Discussion', '5 comments'])}</h2>" + body
        if r.random() < bare:
            return body
        return self.wrap(r.choice(NOISE[kind]) if named else self.unnamed("div", "div", "section", "ul" if kind == "menu" else "div"), body)

    def article(self, bare: float = 0.05) -> str:
        """bare: how often nothing stands around it."""
        r, m = self.r, "\x02"
        out = [f"<h1>{m}{self.words(r.randint(2, 10))}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice([1, 2, 3, 5, 8, 13, 25])):
            kind = r.random()
            if kind < 0.75:
                s = self.sentence(r.choice([1, 3, 8, 20, 40, 60, 150]))
                if r.random() < 0.15:
                    s = f"<b>{s}<br>"
                elif r.random() < 0.15:
                    s += f' <a href="/x">{self.words(2)}</a> ' + self.sentence(4)
                out.append(f"<p>{m}{s}" + ("</p>" if r.random() < 0.85 else ""))
            elif kind < 0.82:
                out.append(f"<h2>{m}{self.words(r.randint(1, 6))}</h2>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{m}{self.sentence(r.randint(1, 15))}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.95:
                out.append(f"<blockquote>{m}{self.sentence(r.randint(5, 40))}</blockquote>")
            elif kind < 0.97:
                out.append("<table><tr>" + "".join(f"<td>{m}{self.words(2)}</td>" for _ in range(3)) + "</tr></table>")
            else:
                out.append(self.noise(r.choice(["advert", "side", "notice"])))
        body = "".join(out)
        if r.random() < 0.3:
            body += self.noise("comments")
        specs = [r.choice(MAIN)] if r.random() < 0.7 else ["main", r.choice(MAIN)]
        kind = r.random()
        if kind < 0.25:
            specs = ["article"]
        elif kind < 0.75:
            specs = [self.unnamed("div", "div", "section", "span")] * r.randint(1, 2)
        for s in reversed([] if r.random() < bare else specs):
            body = self.wrap(s, body)
        return body

    def page(self) -> str:
        r = self.r
        some = lambda kinds, p, bare=0: [self.noise(k, bare) for k in kinds if r.random() < p]
        top = some(["notice", "header", "menu", "advert", "form", "menu", "advert"], 0.45)
        low = some(["comments", "side", "advert", "form", "menu", "notice", "footer"], 0.4)
        if r.random() < 0.5:
            top.append(f'<div class="ad">\x01{self.sentence(r.randint(3, 20))}</div>')
        if r.random() < 0.6:
            low.append(f"<footer>\x01&copy; {self.words(1)}.example &middot; {self.sentence(r.randint(2, 12))}</footer>")
        in_table = r.random() < 0.2
        main = self.article(0.7 if in_table else 0.05) if r.random() < 0.98 else ""
        if r.random() < 0.2:  # little or nothing but the article
            top, low = top[: r.randint(0, 1)], low[: r.randint(0, 1)]
        if in_table:
            cells = "".join(f"<td>{x}</td>" for x in [*some(["menu", "side"], 0.6, 0.6), main, *some(["side", "advert"], 0.4, 0.3)])
            inner = "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in top) + f"<tr>{cells}</tr>" + "".join(f"<tr><td>{x}</td></tr>" for x in low) + "</table>"
        else:
            inner = "".join(top) + main + "".join(low)
        if r.random() < 0.3:
            inner = self.wrap(r.choice(["div.wrapper", "div.container", "div#page"]), inner)
        if r.random() < 0.3:  # no head
            return f"<html><body>{inner}</body></html>" if r.random() < 0.5 else inner
        return f"<!DOCTYPE html><html><head><title>\x01{self.words(r.randint(2, 9))}</title><style>p{{}}</style></head><body>{inner}</body></html>"


def labelled(page: str) -> tuple[list, list[int]]:
    """Blocks and labels; the generator's marks are taken off."""
    found, labels = [], []
    for path, text, linked in blocks(page):
        clean = text.replace("\x01", "").replace("\x02", "").strip()
        if clean:
            found.append((path, clean, min(linked, len(clean))))
            labels.append(1 if "\x02" in text else 0 if "\x01" in text else labels[-1] if labels else 0)
    return found, labels


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {"path": rng.normal(0, 0.1, (PATH_BUCKETS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM))}
    for d in "fb":
        w |= {f"{d}_wx": rng.normal(0, 0.2, (INPUT, 4 * HIDDEN)), f"{d}_wh": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), f"{d}_b": np.zeros(4 * HIDDEN)}
        w[f"{d}_b"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return w | {"out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}


def _backward(w: dict, name: str, x: np.ndarray, mask: np.ndarray, dh_out: np.ndarray, grads: dict) -> np.ndarray:
    """Runs one direction again, keeping its states, then back through time; gives the gradient of x."""
    pages, steps, _ = x.shape
    wx, wh, b = (w[f"{name}_{k}"] for k in ("wx", "wh", "b"))
    times = list(range(steps) if name == "f" else range(steps - 1, -1, -1))
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    kept = []
    for t in times:
        g = x[:, t] @ wx + h @ wh + b
        s = 1 / (1 + np.exp(-g[:, : 3 * HIDDEN]))
        i, f, o, u = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(g[:, 3 * HIDDEN :])
        nc = f * c + i * u
        on = mask[:, t, None]
        kept.append((t, h, c, i, f, o, u, nc, on))
        h, c = np.where(on, o * np.tanh(nc), h), np.where(on, nc, c)
    dx, dh, dc = np.zeros_like(x), np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    for t, h0, c0, i, f, o, u, nc, on in reversed(kept):
        dh = dh + dh_out[:, t]
        tc = np.tanh(nc)
        dh_in, dc_in = np.where(on, dh, 0), np.where(on, dc, 0)
        dnc = dc_in + dh_in * o * (1 - tc**2)
        dg = np.concatenate([dnc * u * i * (1 - i), dnc * c0 * f * (1 - f), dh_in * tc * o * (1 - o), dnc * i * (1 - u**2)], axis=1)
        grads[f"{name}_wx"] += x[:, t].T @ dg
        grads[f"{name}_wh"] += h0.T @ dg
        grads[f"{name}_b"] += dg.sum(0)
        dx[:, t] = dg @ wx.T
        dh = np.where(on, dg @ wh.T, dh)
        dc = np.where(on, dnc * f, dc)
    return dx


def train(seed: int = SEED, pages: int = PAGES, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    rng, source = np.random.default_rng(seed), Pages(seed)
    data = [labelled(source.page()) for _ in range(pages)]
    data = sorted((d for d in data if d[0]), key=lambda d: len(d[0]))
    w = _start(rng)
    m1, m2, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    groups = [data[i : i + BATCH] for i in range(0, len(data), BATCH)]
    for _ in range(epochs):
        for gi in rng.permutation(len(groups)):
            group = groups[gi]
            model = Labeller({k: v.astype(np.float32) for k, v in w.items()})
            steps = max(len(b) for b, _ in group)
            x, y, mask = np.zeros((len(group), steps, INPUT)), np.zeros((len(group), steps)), np.zeros((len(group), steps), bool)
            for r, (b, lab) in enumerate(group):
                x[r, : len(b)], y[r, : len(b)], mask[r, : len(b)] = model.inputs(b), lab, True
            # Paths that no page of training has are met later; hiding some now teaches to use the context.
            hide = rng.random(mask.shape) < 0.1
            x[..., :PATH_DIM][hide] = 0
            x32 = x.astype(np.float32)
            h = np.concatenate([model._direction("f", x32, mask), model._direction("b", x32, mask)], axis=2).astype(float)
            p = 1 / (1 + np.exp(-(h @ w["out"] + w["bias"])))
            d = np.where(mask, p - y, 0) / mask.sum()
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            grads["out"], grads["bias"] = (h * d[..., None]).sum((0, 1)), np.array([d.sum()])
            dh = d[..., None] * w["out"]
            dx = _backward(w, "f", x, mask, dh[..., :HIDDEN], grads) + _backward(w, "b", x, mask, dh[..., HIDDEN:], grads)
            dx[..., :PATH_DIM][hide] = 0
            for r, (b, _) in enumerate(group):
                for t, (path, text, _) in enumerate(b):
                    keys = list(_path_keys(path))
                    np.add.at(grads["path"], keys, dx[r, t, :PATH_DIM])
                    ws = [_word_bucket(v) for v in text.lower().split()]
                    np.add.at(grads["word"], ws, dx[r, t, PATH_DIM : PATH_DIM + WORD_DIM] / len(ws))
            step += 1
            for k in w:
                m1[k] = 0.9 * m1[k] + 0.1 * grads[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grads[k] ** 2
                w[k] = w[k] - RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


def accuracy(w: dict[str, np.ndarray], seed: int, pages: int = 300) -> float:
    """Share of blocks labelled right on pages generated from another seed."""
    source = Pages(seed)
    data = [d for d in (labelled(source.page()) for _ in range(pages)) if d[0]]
    scores = Labeller(w).score([b for b, _ in data])
    hits = [(p >= 0.5) == np.array(lab, bool) for p, (_, lab) in zip(scores, data, strict=True)]
    return float(np.concatenate(hits).mean())


if __name__ == "__main__":
    assert MEASURES == 4
    made = train()
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in made.items()})
    print("held-out accuracy", accuracy(made, SEED + 1))
