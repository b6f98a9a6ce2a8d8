"""Labelled pages from which the extraction model is trained.

Each page is put together from fragments labelled by hand: ``m`` marks an element whose text is
main text, ``x`` one inside or outside whose text is not. The model never sees the marks.
"""

from __future__ import annotations

import random

# Sentences, short phrases and labelled fragments of pages.
SENTENCES = (
    "The council met on Tuesday to discuss the new bridge over the river.",
    "Nobody had expected so many visitors, and the staff worked until midnight.",
    "Der Zug fuhr wegen des Schnees erst am Abend weiter.",
    "Après la réunion, le maire a promis de publier les comptes.",
    "Los vecinos piden que se arregle la calle antes del invierno.",
    "In 1987 the factory employed 300 people; today it is a museum.",
    "Prices rose by 4.5 % in March, the third increase in a row.",
    "She opened the letter, read it twice and put it into the drawer.",
    "A second test gave the same result (see the table below).",
    "Why did it take so long? The answer is simple: money.",
)
SHORT = (
    "Update", "Day two", "It rained.", "OK THEN!!", "One | two | three", "What next?",
    "Results", "Part 3", "No.", "a*** b%%% c&amp;&amp;&amp;", "BUY NOW!! CHEAP!! REAL!!",
)
RUNS = (
    "cheap cheap cheap cheap best best best best price price price", "one | two | three | four |",
    "THE!! BEST!! OFFER!! OF!! ALL!! TIMES!!", "lorem$$$ ipsum### dolor%%% sit*** amet&amp;&amp;",
)
WORDS = (
    "Home", "News", "Sport", "About us", "Contact", "Login", "World", "Culture", "Shop",
    "Archive", "Help", "Imprint", "Privacy", "Jobs", "FAQ", "Video", "Weather", "Next",
)
MAIN = (
    "<article m>{}</article>", "<article m>{}</article>", "<article m>{}</article>",
    "<article m>{}</article>", "<article m>{}</article>", "<div id='page'><article m>{}</article></div>",
    "<article class='post hentry' m>{}</article>",
    "<main m>{}</main>", "<main m>{}</main>",
    "<main id='main' m><article m>{}</article></main>",
    "<div class='content' m>{}</div>",
    "<div id='content' m><div class='article-body' m>{}</div></div>",
    "<div class='story' m>{}</div>",
    "<section class='entry-content' m>{}</section>",
    "<div class='post-body' itemprop='articleBody' m>{}</div>",
    "<div class='wrapper' m><div class='text' m>{}</div></div>",
    "<table><tr><td class='body' m>{}</td></tr></table>",
    "<div m>{}</div>",
    "<div role='main' m>{}</div>",
)
BLOCKS = (
    "<h1>{t}</h1>", "<h2>{k}</h2>", "<p>{p}</p>", "<p>{p}</p>", "<p>{s}</p>", "<p>{k}</p>",
    "<p><b>{s}</b> {p}</p>", "<p>{s} <a href='/x'>{k}</a> {s}</p>", "<ul><li>{s}</li><li>{k}</li></ul>",
    "<blockquote><p>{s}</p></blockquote>", "<p><b>{p}<br>", "<div>{p}</div>", "<pre>{s}</pre>",
    "<table><tr><th>{k}</th><td>{s}</td></tr></table>", "<h3>{k}</h3>", "<p><em>{k}</em></p>",
    "<figure><img src='a.png'><figcaption>{s}</figcaption></figure>", "<ol><li>{p}</li></ol>",
    "<p>{k}</p>", "<p>{r}</p>", "<p><b>{r}<br>", "<p>{r}</p>", "<h1>{r}</h1>", "<p>{s}<br>{s}</p>", "{s}<br><br>{p}", "<section><h2>{k}</h2><p>{p}</p></section>",
    "<header><h1>{t}</h1></header>", "<dl><dt>{k}</dt><dd>{s}</dd></dl>",
)
INNER = (
    "<div class='ad' x>{s}</div>", "<aside x>{p}</aside>", "<div class='share social' x>{l}</div>",
    "<div class='advert' x>{s}</div>", "<div class='related' x><h3>{w}</h3>{l}</div>",
    "<form class='newsletter' x><label>{w}</label><input><button>{w}</button></form>",
    "<section class='comments' x><h2>Comments</h2>{c}</section>",
    "<div id='comments' x>{c}</div>", "<footer x>{s}</footer>", "<nav class='toc' x>{l}</nav>",
    "<div class='promo sponsored' x>{p}</div>", "<ul class='tags' x><li>{w}</li><li>{w}</li></ul>",
    "<div class='banner-ad' x><a href='/buy'>{s}</a></div>",
    "<div class='notice' x>{s}</div>", "<p class='byline meta' x>{w} {w}</p>",
)
BEFORE = (
    "<nav><ul>{l}</ul></nav>", "<header><h1>{w}</h1><p>{s}</p></header>", "<div class='ad'>{s}</div>",
    "<div class='ad'>{p}</div>", "<div id='header'><a href='/'>{w}</a> {s}</div>", "<nav>{l}</nav>",
    "<div class='cookie-notice'>{s} <button>{w}</button></div>", "<div class='menu'>{l}</div>",
    "<form action='/search'><input name='q'><button>{w}</button></form>",
    "<div class='breadcrumb'>{l}</div>", "<aside class='sidebar'><h3>{w}</h3><p>{p}</p>{l}</aside>",
    "<div class='notice'>{s}</div>", "<div class='advertisement'><p>{p}</p></div>",
    "<div id='cookie-banner' role='dialog'><p>{p}</p><a href='#'>{w}</a></div>",
    "<div class='topbar'>{w} | {w}</div>", "<ul class='nav'>{l}</ul>", "<div class='alert'>{s}</div>",
    "<div role='navigation'>{l}</div>", "<div class='site-header'><p>{s}</p></div>",
    "<div role='banner'>{s}</div>", "<div class='subscribe'><p>{s}</p></div>",
    "<div class='ads'><p>{s}</p></div>", "<div class='gdpr consent'>{p}</div>",
)
AFTER = (
    "<footer>{s}</footer>", "<footer>&copy; a.example.com &middot; {s}</footer>",
    "<footer><p>{p}</p>{l}</footer>", "<div id='footer'>{s} {l}</div>",
    "<div id='sidebar'><h3>{w}</h3><p>{p}</p><ul>{l}</ul></div>", "<div class='sidebar'><p>{p}</p></div>",
    "<section id='comments'><h2>{w}</h2>{c}</section>", "<div class='comments'>{c}</div>",
    "<div class='comment-list'>{c}</div>", "<ol class='commentlist'>{c}</ol>", "<div class='widget'>{l}</div>",
    "<aside><p>{p}</p></aside>", "<div class='related-posts'><h3>{w}</h3>{l}</div>",
    "<div class='ad'>{s}</div>", "<div class='sponsor'><p>{s}</p></div>",
    "<form id='contact'><p>{s}</p><textarea>{s}</textarea><input type='submit'></form>",
    "<div class='copyright'>{s}</div>", "<div class='disclaimer legal'><p>{p}</p></div>",
    "<div class='recommended'>{l}</div>", "<div class='newsletter'><p>{s}</p><form><input></form></div>",
    "<div role='contentinfo'>{s}</div>", "<div role='complementary'><p>{p}</p></div>",
    "<div class='popup modal'><p>{s}</p></div>", "<div class='reader-comments'><p>{p}</p></div>",
    "<div class='site-footer'><p>{s}</p></div>", "<div class='pagination'>{l}</div>",
    "<div class='social-share'>{l}</div>", "<div class='responses'>{c}</div>",
)
COMMENT = (
    "<div class='comment'><b>{w}</b><p>{p}</p></div>", "<li class='comment'><p>{s}</p></li>",
    "<article class='comment'><p>{p}</p></article>", "<div class='comment-body'>{s}</div>",
)


def pages(count: int = 400, seed: int = 7) -> list[str]:
    """Pages with marks, always the same for equal arguments."""
    pick = random.Random(seed)

    def links() -> str:
        shape = pick.choice(("<li><a href='/{0}'>{0}</a></li>", "<a href='/{0}'>{0}</a> "))
        return "".join(shape.format(pick.choice(WORDS)) for _ in range(pick.randint(2, 6)))

    def fill(text: str) -> str:
        while "{" in text:
            at = text.index("{")
            slot, end = text[at + 1], at + 3
            new = {
                "p": lambda: " ".join(pick.choices(SENTENCES, k=pick.randint(2, 9))),
                "s": lambda: pick.choice(SENTENCES),
                "t": lambda: pick.choice(SENTENCES)[:60],
                "k": lambda: pick.choice(SHORT),
                "r": lambda: " ".join(pick.choices(RUNS, k=pick.randint(1, 9))),
                "w": lambda: pick.choice(WORDS),
                "l": links,
                "c": lambda: "".join(pick.choices(COMMENT, k=pick.randint(1, 3))),
            }[slot]()
            text = text[:at] + new + text[end:]
        return text

    def page() -> str:
        blocks = pick.choices(BLOCKS, k=pick.randint(1, 9))
        if pick.random() < 0.4:
            blocks.insert(pick.randint(0, len(blocks)), pick.choice(INNER))
        before = "".join(pick.sample(BEFORE, pick.randint(0, 4)))
        after = "".join(pick.sample(AFTER, pick.randint(0, 4)))
        main = pick.choice(MAIN).format("".join(blocks).replace("{", "{{").replace("}", "}}"))
        main = main.replace("{{", "{").replace("}}", "}")
        head = "<!DOCTYPE html><html><head><title>{w}</title><style>p{margin:0}</style></head>"
        return head.replace("{w}", "A page") + "<body>" + fill(before + main + after) + "</body></html>"

    return [page() for _ in range(count)]
