"""The labelled table of the page classifier: small pages, block by block.

Each page is a list of rows (label, elements around the block, words in links,
words of plain text). Label 1 is main text. ``pages`` writes them as HTML, from
which the classifier's features are measured as from any page.
"""

from __future__ import annotations

from itertools import takewhile

# Pages with semantic elements, with telling class names, and with neither.
LABELLED = (
    ((0, "nav/ul/li", 1, 0), (0, "nav/ul/li", 1, 0), (0, "nav/ul/li", 2, 0), (0, "div.ad", 0, 9), (1, "article/h1", 0, 8),
     (1, "article/p", 0, 60), (1, "article/p", 0, 25), (1, "article/p", 0, 1), (1, "article/p", 0, 90), (1, "article/p", 2, 30),
     (0, "footer", 0, 12)),
    ((0, "nav/ul/li", 1, 0), (0, "nav/ul/li", 1, 0), (0, "div.ad", 0, 40), (1, "article/h1", 0, 3), (1, "article/p", 0, 1),
     (1, "article/p", 0, 2), (0, "footer", 0, 30)),
    ((0, "header/div", 0, 3), (0, "header/nav/li", 1, 0), (0, "header/nav/li", 1, 0), (1, "main/article/h1", 0, 7),
     (1, "main/article/p", 0, 45), (1, "main/article/ul/li", 0, 6), (1, "main/article/ul/li", 3, 0), (1, "main/article/p", 0, 70),
     (0, "main/article/aside/p", 0, 35), (1, "main/article/p", 0, 33), (0, "aside/ul/li", 4, 0), (0, "aside/p", 0, 40),
     (0, "form/p", 0, 2), (0, "footer/p", 3, 6)),
    ((0, "div.header", 0, 4), (0, "div.menu/li", 1, 0), (0, "div.menu/li", 2, 0), (0, "div.cookie-notice/p", 1, 22),
     (1, "div.content/h1", 0, 6), (1, "div.content/p", 0, 55), (1, "div.content/p", 0, 4), (1, "div.content/p", 1, 40),
     (0, "div.sidebar/h3", 0, 2), (0, "div.sidebar/p", 0, 28), (0, "div.sidebar/li", 3, 0), (0, "div.comments/h3", 0, 2),
     (0, "div.comments/p", 0, 50), (0, "div.comments/p", 0, 12), (0, "div.footer/p", 0, 15)),
    ((0, "header/h1", 0, 4), (0, "section.notice/p", 0, 30), (1, "article/header/h1", 0, 9), (0, "article/header/p.byline", 1, 4),
     (1, "article/p", 0, 80), (1, "article/blockquote/p", 0, 30), (1, "article/table/td", 0, 3), (1, "article/table/td", 0, 2),
     (0, "article/div.share/li", 1, 0), (0, "article/footer/p", 2, 6), (0, "section.comments/article/p", 0, 60),
     (0, "section.comments/article/p", 0, 20), (0, "section.related/li", 8, 0), (0, "footer/p", 0, 20)),
    ((0, "div/li", 1, 0), (0, "div/li", 1, 0), (0, "div/li", 1, 0), (0, "div/li", 2, 0), (1, "div/h1", 0, 9), (1, "div/p", 0, 60),
     (1, "div/p", 0, 45), (1, "div/p", 3, 50), (1, "div/p", 0, 12), (1, "div/p", 0, 70), (1, "div/p", 0, 38), (0, "div/li", 6, 0),
     (0, "div/li", 7, 0), (0, "div/li", 5, 0), (0, "div", 3, 5)),
    ((0, "div/li", 2, 0), (0, "div/li", 2, 0), (0, "div", 0, 4), (1, "div/p", 0, 110), (1, "div/p", 0, 16), (1, "div/p", 2, 65),
     (1, "div/p", 0, 80), (0, "div/li", 3, 0), (0, "div/li", 4, 0), (0, "div", 1, 3), (0, "div/li", 2, 0)),
    ((0, "td/li", 2, 0), (0, "td/li", 1, 0), (0, "td/li", 2, 0), (0, "td", 0, 3), (1, "td", 0, 200), (1, "td", 0, 150), (0, "td", 4, 2),
     (0, "td/li", 5, 0)),
    ((0, "div.nav/li", 1, 0), (0, "div.banner", 0, 6), (1, "div.post/h2", 0, 6), (1, "div.post/p", 0, 30), (1, "div.post/p", 0, 3),
     (1, "div.post/pre", 0, 40), (0, "div.post/div.advert", 0, 15), (1, "div.post/p", 0, 22), (0, "div.related-posts/li", 5, 0),
     (0, "div.newsletter/p", 0, 18), (0, "form/p", 0, 9), (0, "div.copyright", 0, 8)),
    ((0, "header/p", 0, 10), (0, "nav/li", 1, 0), (1, "main/h1", 0, 5), (1, "main/p", 0, 2), (1, "main/p", 0, 5), (0, "main/form/p", 0, 12),
     (0, "main/nav/li", 2, 0), (1, "main/p", 0, 40), (0, "aside.widget/p", 0, 60), (0, "footer/p", 0, 44)),
    ((0, "div/p", 0, 14), (0, "div/p", 0, 40), (1, "article/h1", 0, 6), (1, "article/p", 0, 30), (1, "article/p", 0, 10),
     (1, "article/p", 1, 80), (0, "div/p", 0, 22), (0, "section/p", 0, 3), (0, "div/p", 0, 130)),
    ((0, "section/p", 0, 6), (0, "div/li", 2, 0), (1, "article/h1", 0, 4), (1, "article/p", 0, 2), (1, "article/p", 0, 90),
     (0, "section/p", 0, 50), (0, "div/p", 2, 30)),
    ((0, "div", 0, 2), (0, "div/li", 2, 0), (0, "div/li", 2, 0), (1, "div/h1", 0, 5), (1, "div/p", 0, 40), (1, "div/p", 0, 20),
     (1, "div/p", 0, 35), (1, "div/h2", 0, 2), (1, "div/p", 0, 50), (0, "div/li", 4, 0), (0, "div", 0, 4), (0, "div/li", 2, 0)),
    ((0, "div/p", 0, 70), (0, "div/p", 0, 95), (1, "article/p", 0, 60), (1, "article/p", 0, 44), (1, "article/p", 0, 200),
     (0, "div/p", 0, 64), (0, "div/p", 0, 110), (0, "div", 5, 20), (0, "div", 60, 8)),
    ((0, "div/p", 0, 160), (1, "main/p", 0, 20), (1, "main/p", 0, 150), (1, "main/p", 0, 300), (0, "div/p", 0, 90), (0, "div/p", 0, 60)),
    ((0, "div", 70, 0), (0, "div", 60, 9), (1, "div/p", 0, 90), (1, "div/p", 6, 70), (1, "div/p", 0, 60), (0, "div", 80, 10),
     (0, "div", 55, 20), (0, "div", 110, 30), (0, "div", 0, 3)),
    ((0, "td", 90, 0), (0, "td", 66, 10), (1, "td", 10, 400), (0, "td", 70, 25), (1, "td", 0, 300), (0, "td", 100, 40)),
    ((0, "div.cookie-banner/p", 0, 30), (0, "nav/li", 1, 0), (0, "nav/li", 1, 0), (1, "div/h1", 0, 4), (1, "div/p", 0, 60), (1, "div/p", 0, 3),
     (1, "div/p", 0, 48), (1, "div/h2", 0, 3), (1, "div/p", 0, 44), (1, "div/p", 0, 4), (1, "div/p", 0, 52), (0, "aside/p", 0, 26),
     (0, "div.comments/p", 0, 45), (0, "div.comments/p", 0, 33), (0, "footer/p", 0, 21)),
    ((0, "div.top-menu/li", 2, 0), (0, "div.ads", 0, 18), (1, "div/h2", 0, 2), (1, "div/p", 0, 75), (1, "div/p", 0, 2), (1, "div/p", 0, 66),
     (1, "div/h2", 0, 4), (1, "div/p", 0, 31), (0, "div.widget/p", 0, 40), (0, "form/p", 0, 14), (0, "div.disclaimer/p", 0, 70)),
    ((0, "div.popup/p", 0, 25), (0, "div.breadcrumb/li", 1, 0), (1, "article/p", 0, 18), (1, "article/p", 20, 5), (1, "article/li", 4, 1),
     (0, "article/div.ad", 0, 20), (0, "article/div.comment/p", 0, 45), (1, "article/p", 0, 7), (0, "div.promo/p", 0, 33)),
)


# Every page also counts with longer main text and, where elements tell what is main text, with shorter, and with more of all.
LONGER, SHORTER, MORE = (4, 15), (3, 10), 12


def pages() -> list[tuple[str, list[int]]]:
    """(HTML, label of each block in order) of every labelled page at several lengths of its main text."""
    out = []
    for rows in LABELLED:
        out += [_page([(y, path, linked * by, plain * by) if y else (y, path, linked, plain) for y, path, linked, plain in rows])
                for by in (1, *LONGER)]
        if any(path.startswith(("article", "main")) for _, path, _, _ in rows):
            out += [_page([(y, path, -(-linked // by), -(-plain // by)) if y else (y, path, linked, plain)
                           for y, path, linked, plain in rows]) for by in SHORTER]
        if any("article" in path or "main" in path or "." in path for _, path, _, _ in rows):
            out.append(_page([(y, path, linked * MORE, plain * MORE) for y, path, linked, plain in rows]))
    return out


def _page(rows) -> tuple[str, list[int]]:
    out, open_elements = ["<html><body>"], []
    for _, path, linked, plain in rows:
        wanted = path.split("/")
        # Rows that follow one another share the elements around them; the innermost is always a new one.
        same = len(list(takewhile(lambda pair: pair[0] == pair[1], zip(open_elements, wanted[:-1]))))
        out += [f"</{name.split('.')[0]}>" for name in reversed(open_elements[same:])]
        for name in wanted[same:]:
            tag, _, kind = name.partition(".")
            out.append(f'<{tag} class="{kind}">' if kind else f"<{tag}>")
        if linked:
            out.append(f"<a>{' '.join(['w'] * linked)}</a> ")
        out.append(" ".join(["w"] * plain))
        out.append(f"</{wanted[-1].split('.')[0]}>")
        open_elements = wanted[:-1]
    return "".join(out) + "</body></html>", [r[0] for r in rows]
