"""Pages made by hand, as unlike as pages are: (name, html, texts of the main blocks)."""

A = "The harbour of the old town was built when ships still came up the river twice a week, and most of its walls stand to this day."
B = "Nobody knows who drew the first plan. The city archive holds three copies, none of them signed, and the oldest is dated 1741."
C = "After the flood the council had the lower quay raised by two metres; the stones came from a quarry that closed ten years later."
D = "Today the warehouses are flats and studios. In summer there is a market every Saturday, which draws people from all over the county."
E = "Short one."
HEAD = "A harbour and its walls"

NAV = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li><li><a href="/c">Contact</a></li></ul>'
FOOT = "<p>Copyright 2021 Harbour Media Ltd</p>"


def paras(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def page(body, title="Harbour - Town news"):
    return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}</body></html>"


MAIN = [HEAD, A, B, C, D]
BODY = f"<h1>{HEAD}</h1>{paras(A, B, C, D)}"
COMMENTS = "".join(f"<li><article><p>{t}</p></article></li>" for t in ("I grew up there and it was never like that.", "Lovely piece, thank you for writing it!"))

PAGES = [
    ("plain article", page(f"<nav>{NAV}</nav><article>{BODY}</article><footer>{FOOT}</footer>"), MAIN),
    ("main", page(f"<header><a href='/'>Town news</a></header><main>{BODY}</main><footer>{FOOT}</footer>"), MAIN),
    ("div of an unseen id", page(f"<div id='zqv'>{NAV}</div><div id='story'>{BODY}</div><div id='krell'>{FOOT}</div>"), MAIN),
    ("strange names", page(f"<div class='bnx'>{NAV}</div><div class='wpt'><div class='lmo'>{BODY}</div></div><div class='rrz'>{FOOT}</div>"), MAIN),
    ("no names at all", page(f"{NAV}{BODY}{FOOT}"), MAIN),
    ("no names, in boxes", page(f"<div>{NAV}</div><div>{BODY}</div><div>{FOOT}</div>"), MAIN),
    ("comment list of articles", page(f"<nav>{NAV}</nav><article>{BODY}</article><ol class='commentlist'>{COMMENTS}</ol><footer>{FOOT}</footer>"), MAIN),
    ("comments inside the article", page(f"<article>{BODY}<section id='comments'><h3>2 comments</h3><ul>{COMMENTS}</ul></section></article>"), MAIN),
    (
        "list called tags-explained",
        page(f"<nav>{NAV}</nav><article>{BODY}<ul class='tags-explained'><li>Quay: the wall that ships lie at.</li><li>Mole: a wall in the sea.</li></ul></article>"),
        [*MAIN, "Quay: the wall that ships lie at.", "Mole: a wall in the sea."],
    ),
    ("entry title", page(f"<nav>{NAV}</nav><article><h1 class='entry-title'>{HEAD}</h1>{paras(A, B)}</article>"), [HEAD, A, B]),
    ("header in the article", page(f"<article><header><h1>{HEAD}</h1></header>{paras(A, B, C)}</article><footer>{FOOT}</footer>"), [HEAD, A, B, C]),
    ("table layout", page(f"<table><tr><td>{NAV}</td><td>{BODY}</td></tr><tr><td>{FOOT}</td></tr></table>"), MAIN),
    ("div content", page(f"<div class='menu'>{NAV}</div><div class='content'>{BODY}</div><div class='footer'>{FOOT}</div>"), MAIN),
    ("gdpr notice", page(f"<div class='gdpr'><p>We use cookies to make this site better for you.</p><button>Accept</button></div><article>{BODY}</article>"), MAIN),
    ("alert by role", page(f"<div role='alert'>Our shop is closed on Monday.</div><main>{BODY}</main>"), MAIN),
    ("cookie dialog below", page(f"<article>{BODY}</article><div id='cookie-consent'><p>This site uses cookies. By going on you agree.</p></div>"), MAIN),
    ("advert inside", page(f"<article><h1>{HEAD}</h1>{paras(A, B)}<div class='advert'>Buy our new boots now, half price.</div>{paras(C, D)}</article>"), MAIN),
    ("adverts around", page(f"<div class='ad'>Boots at half price.</div><article>{BODY}</article><div class='sponsored'><p>A word from our friends at the bank.</p></div>"), MAIN),
    (
        "sidebar",
        page(f"<article>{BODY}</article><aside><h3>Most read</h3><ul><li><a href='1'>Ferry late again</a></li><li><a href='2'>New school opens</a></li></ul></aside>"),
        MAIN,
    ),
    (
        "sidebar first",
        page(f"<div class='sidebar'><h3>About us</h3><p>We write about this town since 1990.</p></div><div class='post'>{BODY}</div>"),
        MAIN,
    ),
    (
        "related links inside",
        page(f"<article>{BODY}<div class='related'><h4>Read more</h4><ul><li><a href='1'>Ferry late again</a></li><li><a href='2'>New school</a></li></ul></div></article>"),
        MAIN,
    ),
    ("share links", page(f"<article><h1>{HEAD}</h1><div class='share'><a href='t'>Tweet</a> <a href='f'>Like</a></div>{paras(A, B, C)}</article>"), [HEAD, A, B, C]),
    (
        "newsletter form",
        page(f"<article>{BODY}<form><p>Get our letter every week</p><label>Mail</label><button>Send</button></form></article><footer>{FOOT}</footer>"),
        MAIN,
    ),
    ("search form on top", page(f"<form><label>Search</label><button>Go</button></form><div class='entry'>{BODY}</div>"), MAIN),
    (
        "lists in the article",
        page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1>{paras(A)}<ul><li>three cranes</li><li>one lighthouse</li></ul>{paras(B)}</article>"),
        [HEAD, A, "three cranes", "one lighthouse", B],
    ),
    (
        "quotation and code",
        page(f"<main><h1>{HEAD}</h1>{paras(A)}<blockquote><p>We built it on sand.</p></blockquote><pre>depth = 4 * tide</pre>{paras(B)}</main>"),
        [HEAD, A, "We built it on sand.", "depth = 4 * tide", B],
    ),
    (
        "table in the article",
        page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1>{paras(A)}<table><tr><th>Year</th><th>Ships</th></tr><tr><td>1800</td><td>212</td></tr></table>{paras(B)}</article>"),
        [HEAD, A, "Year", "Ships", "1800", "212", B],
    ),
    ("headings between", page(f"<main><h1>{HEAD}</h1>{paras(A)}<h2>The plan</h2>{paras(B)}<h2>The flood</h2>{paras(C)}</main>"), [HEAD, A, "The plan", B, "The flood", C]),
    ("breadcrumbs", page(f"<div class='breadcrumbs'><a href='/'>Home</a> &gt; <a href='/t'>Town</a></div><article>{BODY}</article>"), MAIN),
    ("deep boxes", page(f"<div><div><div>{NAV}</div><div><div><div>{BODY}</div></div></div></div></div><div>{FOOT}</div>"), MAIN),
    ("short article", page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1>{paras(E, A)}</article><footer>{FOOT}</footer>"), [HEAD, E, A]),
    ("spans for links", page(f"<div class='qq1'><span><a href='/'>Home</a></span> <span><a href='/n'>News</a></span></div><div class='uvw'>{BODY}</div>"), MAIN),
    ("links in the text", page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{A} See <a href='x'>the archive</a>.</p>{paras(B)}</article>"), [HEAD, A + " See the archive.", B]),
    ("footer of links", page(f"<article>{BODY}</article><div id='bottom'><a href='i'>Imprint</a> <a href='p'>Privacy</a></div>"), MAIN),
    ("discussion", page(f"<section class='zzt'>{BODY}</section><div class='comments'><h3>Comments</h3>{paras('First! Great read.', 'I do not agree with a word of this.')}</div>"), MAIN),
    ("unclosed tags", f"<html><title>T</title><body><nav><ul><li><a href=1>One<li><a href=2>Two</ul></nav><article><h1>{HEAD}<p>{A}<p>{B}", [HEAD, A, B]),
]
