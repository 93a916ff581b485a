"""Small pages in which the main text is marked, to learn the weights of HTML extraction from.

The region from ``<!--[-->`` to ``<!--]-->`` is the article, with what is embedded in it.
"""

PAGES = (
    """<html><head><title>One</title><style>p{margin:0}</style></head><body><header class="site-header"><a href="/">Home page</a> <span>The daily site</span></header>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport and games</a></li><li><a href="/c">Contact</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to improve what you see here. <button>Accept all</button></p></div>
<article><!--[--><h1>A long walk along the river</h1><p>The river begins in the hills, where <a href="/hills">small springs</a> meet below the old road.</p>
<div class="ad"><p>Buy the new boots now, half price this week only.</p></div>
<p>It runs past three villages and a mill. <em>Nobody</em> knows how old the mill is, but it still turns in spring.</p><p>Then it widens.</p>
<ul><li>Bring water and a map.</li><li>Start early in the morning.</li></ul><p>From the last bridge the path goes back through the woods to the station.</p><!--]--></article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this walk very much, thank you for the map.</p></div></section>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Ten more walks</a></li><li><a href="/y">A mill for sale</a></li></ul></aside>
<footer>&copy; The daily site. All rights reserved. <a href="/imprint">Imprint</a></footer></body></html>""",
    """<html><body><div id="top-menu"><a href="/1">Start</a> | <a href="/2">Archive</a> | <a href="/3">About us</a></div><table><tr><td>Search the site</td></tr></table>
<div id="content"><!--[--><h2>How bread rises</h2><p>Yeast eats sugar and breathes out gas. The dough holds the gas in many small bubbles.</p><p>Warm rooms make it faster, and cold ones slower.<br>A night in the cold gives more taste.</p>
<blockquote>Patience is the cheapest ingredient, my teacher used to say.</blockquote><pre>500 g flour</pre><p>Bake it hot.</p><!--]--></div>
<div><a href="/r1">More recipes</a><a href="/r2">Cakes</a><a href="/r3">Soups of the season</a></div><div class="newsletter-signup"><form><label>Your address</label><input name="m"><p>Get our letter every week, free of charge.</p></form></div>
<div class="bottom">Page made in 2019, last changed in 2020. Print this page.</div></body></html>""",
    """<html><body><nav class="breadcrumb"><a href="/">Home</a> &gt; <a href="/t">Travel</a></nav><main><div class="share-buttons"><a href="#">Share</a> <a href="#">Send</a></div>
<!--[--><h1>Three days by train</h1><p class="lead">We went from the sea to the mountains without a car, and it was easy.</p><figure><img src="a.png"><figcaption>The valley line in winter.</figcaption></figure>
<p>On the first day the train was late by an hour. We read, ate bread, and looked out of the window.</p><h2>The second day</h2><p>Snow.</p><p>In the evening the lights of the town came up slowly, one after another, and somebody played a guitar.</p><!--]-->
<div class="related-posts"><h4>Read next</h4><p>Four days by boat, a journey along the coast.</p></div></main><div class="ads"><p>Cheap tickets to everywhere, book today and save.</p></div>
<div class="popup modal"><p>Please log in to read on, or create an account.</p></div><footer><p>Contact, imprint, privacy. Copyright by the travel page.</p></footer></body></html>""",
    """<html><body><div class="header"><h1><a href="/">My notes</a></h1><p>Words about this and that</p></div><div class="post"><!--[--><h2>Why I keep bees</h2><p>Bees are quiet company. In summer I sit beside the hive and count those that come home with full legs.</p>
<p>They need little: a dry place, flowers, and to be left alone most of the time.</p><div>One box gave twenty jars last year.</div><p>This year we will see.</p><!--]--></div>
<div class="comments-area"><p>Anna says: we have two boxes on the roof and love them.</p><p>Paul says: mine were gone in spring, I don't know why.</p></div>
<div class="widget"><ul><li><a href="/1">May</a></li><li><a href="/2">June</a></li><li><a href="/3">July</a></li></ul></div></body></html>""",
    """<html><body><a href="#main">Skip</a><div role="navigation"><a href="/p">Products</a><a href="/q">Prices</a></div><div role="main"><!--[--><p>The museum is open from ten to six, on Thursdays until eight.</p><p>Children pay nothing. Groups are asked to write to us before they come, since the rooms are small.</p>
<table><tr><td>Adults</td><td>eight euros</td></tr></table><p>Dogs stay outside.</p><!--]--></div><div role="complementary"><p>Our shop has books and prints for sale.</p></div><div role="contentinfo">The museum, Market street 5. Legal notice.</div></body></html>""",
)
