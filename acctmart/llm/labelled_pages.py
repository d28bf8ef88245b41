"""Labelled pages for training the extraction model: common page layouts, composed by rule.

``data-main="1"`` marks an element whose text is main text with all below it, ``data-main="0"`` one whose text isn't. The model never
sees that attribute.
"""

from __future__ import annotations

_SENTENCE = "The committee met again on Tuesday, and after a long debate it agreed to publish the full report by the end of spring."
_SHORT = "A short remark closes the section."
_TITLE = "Committee agrees on a date"


def _paragraphs(n: int) -> str:
    return "".join(f"<p>{' '.join([_SENTENCE] * (1 + k % 3))}</p>" for k in range(n))


#: Main texts in the forms in which pages have them.
MAINS = (
    f'<article data-main="1"><h1>{_TITLE}</h1>{_paragraphs(3)}</article>',
    f'<article data-main="1"><h1>{_TITLE}</h1><p><b>{_SENTENCE}<br>{_paragraphs(2)}<p>{_SHORT}</p></article>',
    f'<article data-main="1"><h1>{_TITLE}</h1><p>{_SHORT}</p></article>',
    f'<article data-main="1"><h1>{_TITLE}</h1></article>',
    f'<main data-main="1"><h1>{_TITLE}</h1>{_paragraphs(2)}<h2>Details</h2><ul><li>{_SHORT}</li><li>{_SHORT}</li></ul>{_paragraphs(1)}</main>',
    f'<div class="post-content" data-main="1"><h2>{_TITLE}</h2>{_paragraphs(3)}<blockquote><p>{_SENTENCE}</p></blockquote></div>',
    f'<div id="content" data-main="1"><div class="entry"><h1>{_TITLE}</h1>{_paragraphs(2)}<pre>x = 1</pre></div></div>',
    f'<main><article class="story" data-main="1"><h1>{_TITLE}</h1><section>{_paragraphs(2)}</section><section><h3>More</h3>{_paragraphs(2)}</section></article></main>',
    f'<div class="wrap"><div class="article-body" data-main="1">{_paragraphs(4)}<table><tr><th>Year</th><td>Number of members</td></tr></table></div></div>',
    f'<article data-main="1"><h1>{_TITLE}</h1>{_paragraphs(1)}<p>See <a href="/a">the report of last year</a> and {_SHORT}</p><p><a href="/b">All the documents</a></p></article>',
    f'<div data-main="1"><h1>{_TITLE}</h1>{_paragraphs(5)}</div>',
    f'<article data-main="1"><h1>{_TITLE}</h1><figure><figcaption>{_SHORT}</figcaption></figure>{_paragraphs(2)}<ol><li>First point</li><li>Second point</li></ol></article>',
)
#: What stands within a main text without being part of it.
INNER = (
    '<div class="ad" data-main="0">Buy one, get one free this week only!</div>',
    '<div class="share-buttons" data-main="0"><a href="#">Share</a> <a href="#">Tweet</a></div>',
    f'<section class="comments" data-main="0"><h3>Comments</h3><div class="comment"><p>{_SENTENCE}</p></div><div class="comment"><p>I agree.</p></div></section>',
    '<aside class="related" data-main="0"><h4>Related</h4><ul><li><a href="/1">Another story of the week</a></li></ul></aside>',
    '<form class="newsletter" data-main="0"><label>Your address</label><p>Subscribe to our letter</p></form>',
    '<div class="advertisement sponsored" data-main="0"><p>Sponsored: the best shoes of the year.</p></div>',
)
#: What stands before and after.
BEFORE = (
    '<nav data-main="0"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact</a></li></ul></nav>',
    '<header data-main="0"><div class="logo"><a href="/">The Daily</a></div><nav><a href="/a">News</a><a href="/b">Sport</a></nav></header>',
    f'<div class="cookie-notice" data-main="0"><p>We use cookies. {_SENTENCE}</p><a href="#">Accept</a></div>',
    '<div id="menu" data-main="0"><ul><li><a href="/x">Products</a></li><li><a href="/y">Prices</a></li></ul></div>',
    f'<div class="banner ad" data-main="0">{_SENTENCE}</div>',
    '<div class="breadcrumbs" data-main="0"><a href="/">Home</a> &gt; <a href="/n">News</a></div>',
    '<form class="search" data-main="0"><p>Search this site</p></form>',
    f'<div class="notice" data-main="0"><p>{_SENTENCE}</p></div>',
    f'<div class="ad" data-main="0">{_SHORT}</div>',
)
AFTER = (
    f'<footer data-main="0">&copy; The Daily &middot; {_SHORT}</footer>',
    f'<aside data-main="0"><h3>Popular</h3><ul><li><a href="/1">A first story</a></li><li><a href="/2">A second story</a></li></ul><p>{_SHORT}</p></aside>',
    f'<div class="sidebar" data-main="0"><div class="widget"><p>{_SENTENCE}</p></div></div>',
    f'<div id="comments" data-main="0"><ol><li><p>{_SENTENCE}</p></li><li><p>No.</p></li></ol></div>',
    '<div class="footer" data-main="0"><p>All rights reserved. <a href="/i">Imprint</a></p></div>',
    f'<section class="comments" data-main="0"><article class="comment"><p>{_SENTENCE}</p></article><article class="comment"><p>{_SHORT}</p></article></section>',
    '<div class="related-posts" data-main="0"><a href="/3">A third story</a><a href="/4">A fourth story</a></div>',
    f'<footer class="site-footer" data-main="0"><nav><a href="/p">Privacy</a></nav><p>{_SENTENCE}</p></footer>',
)


def labelled_pages() -> list[str]:
    """Every main text with changing surroundings."""
    pages = []
    for k in range(4 * len(MAINS)):
        main = MAINS[k % len(MAINS)]
        if k % 3 == 0:
            cut = main.rfind("</")
            main = main[:cut] + INNER[(k // 3) % len(INNER)] + main[cut:]
        before = "".join(BEFORE[(k * 2 + j * 5) % len(BEFORE)] for j in range(1 + k % 3))
        after = "".join(AFTER[(k * 3 + j * 5) % len(AFTER)] for j in range(1 + k % 2))
        pages.append(f"<html><head><title>{_TITLE}</title></head><body>{before}{main}{after}</body></html>")
    return pages
