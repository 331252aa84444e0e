"""Pages with design markup, derived from the crawled pages.

The crawl carries almost no CSS, forms or images. `styled_pages` adds such markup to every page, as a function
of its page_id and URL, so the extraction jobs have something to find and their work grows with the crawl.
The derivation is one SQL expression that Spark and DuckDB read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

_HEAD = """<style>/* theme {brand} */
:root{--brand-color:#0e2a3b;--accent-color-[[k % 5]]:rgb([[(k * 37) % 256]], [[(k * 91) % 256]], [[(k * 53) % 256]]);--space-size-[[k % 3]]:[[8 + 4 * (k % 6)]]px;--font-main:Inter [[k % 4]];--framer-width:[[k % 7]]px;--framer-text-color-[[k % 2]]:#[[CASE k % 3 WHEN 0 THEN 'f60' WHEN 1 THEN '336699' ELSE '0e2a3b' END]]}
@font-face{font-family:"Inter [[k % 4]]";src:url(https://fonts.gstatic.com/s/inter/v[[k % 4]].woff2) format("woff2");font-weight:[[400 + 100 * (k % 4)]];font-style:normal;font-display:[[CASE WHEN k % 3 = 0 THEN 'block' ELSE 'swap' END]]}
@font-face{font-family:"Brand [[k % 2]]";src:url(/fonts/brand-[[k % 2]].woff) format("woff")}
@font-face{font-family:"Canvas";src:url(https://framerusercontent.com/assets/c[[k % 5]].woff2) format("woff2");font-weight:700}
body{background:#ffffff;color:#111111;font-family:"Inter [[k % 4]]", sans-serif;font-size:16px;line-height:1.5}
.text-style-[[k % 3]]{font-family:"Inter [[k % 4]]", sans-serif;font-size:[[20 + 4 * (k % 8)]]px;font-weight:[[400 + 100 * (k % 5)]];line-height:1.2em;letter-spacing:-0.0[[k % 3]]em;color:var(--accent-color-[[k % 5]], #0e2a3b)}
.text-style-note{font-size:14px;letter-spacing:0.01em}
.card-[[k % 4]]{padding:[[20 + 4 * (k % 6)]]px 20px;margin:0 auto;gap:[[8 + 8 * (k % 3)]]px;border-radius:8px 8px 0 0;display:flex;flex-direction:row;justify-content:center;align-items:[[CASE WHEN k % 2 = 0 THEN 'center' ELSE 'stretch' END]];background:rgba([[k % 9]], 0, 0, 0.[[1 + k % 8]]);color:rgb([[(k * 17) % 256]], [[(k * 29) % 256]], [[(k * 43) % 256]]);max-width:[[900 + 100 * (k % 4)]]px}
.card-[[(k + 1) % 4]]:hover{border-color:#[[CASE k % 3 WHEN 0 THEN 'F60' WHEN 1 THEN '346799' ELSE '0e2a3c' END]];color:var(--ghost-color-[[k % 3]], #abcdef);display:none !important}
.appear-[[k % 2]]{opacity:0;transition-property:translateY;transition-duration:[[200 + 100 * (k % 5)]]ms;transition-delay:0.[[k % 4]]s;transition-timing-function:power2.out}
.btn-[[k % 3]]{background-color:#[[CASE k % 4 WHEN 0 THEN '222222' WHEN 1 THEN '777' WHEN 2 THEN 'bbbbbb' ELSE '0055ff' END]];transition:scale 0.[[2 + k % 5]]s ease-in}
.spin-[[k % 2]]{animation:spin-[[k % 2]] 1.[[k % 5]]s linear;animation-duration:1.[[k % 5]]s;animation-timing-function:linear}
@keyframes spin-[[k % 2]]{from{transform:rotate(0deg)}to{transform:rotate([[90 + 90 * (k % 4)]]deg)}}
@media (max-width:809px){body{font-size:14px}.card-[[k % 4]]{flex-direction:column;gap:[[8 + 8 * (k % 3)]]px;padding:10px}}
@media (min-width:810px) and (max-width:1199px){.card-[[k % 4]]{gap:12px;max-width:[[900 + 100 * (k % 4)]]px}}
@media (min-width:[[1200 + 40 * (k % 3)]]px){body{font-size:18px}}
@media (max-width:[[380 + 10 * (k % 5)]]px){@supports (display:grid){.grid-[[k % 2]]{display:grid;gap:8px}}}
[[CASE WHEN k % 2 = 0 THEN '@media (prefers-color-scheme: dark){body{background:#1a1a2e;color:#e0e0e0}.card{background:#16213e;--accent:var(--x, #0e2a3b)}}' ELSE '' END]][[CASE WHEN k % 7 = 0 THEN '}.tail{color:#123456}' ELSE '' END]]
</style>[[CASE WHEN k % 5 = 0 THEN '<meta name="description" content="A page about things"><link rel="canonical" href="https://x.example/"><meta property="og:title" content="t">' ELSE '' END]]<link rel="preconnect" href="https://fonts.gstatic.com" crossorigin>[[CASE WHEN k % 6 = 1 THEN '<script src="https://www.googletagmanager.com/gtm.js"></script><script src="https://stats.g.doubleclick.net/x.js"></script>' WHEN k % 6 = 2 THEN '<script src="https://events.framer.com/script"></script>' WHEN k % 6 = 3 THEN '<script src="https://frog.wix.com/bi"></script>' ELSE '' END]]"""

_BODY = """<div id="main" data-project-id="[[CASE WHEN k % 3 = 0 THEN lower(regexp_extract(url, '^https?://([^/?#.]+)', 1)) ELSE 'other' END]]"><h2 id="sec">Part</h2>[[CASE WHEN k % 4 = 3 THEN '<h4 id="sec">Skipped</h4>' ELSE '' END]][[CASE WHEN k % 9 = 0 THEN '<h1>Again</h1>' ELSE '' END]]<div class="hero" data-framer-appear-id="a[[k % 3]]">x</div><section data-framer-appear-id="b[[k % 5]]"></section><p data-framer-appear-id="a[[k % 3]]">y</p>
<img src="https://framerusercontent.com/images/Hero[[k % 9]].png?scale=2" srcset="https://framerusercontent.com/images/hero[[k % 9]].png 1x, https://cdn.example.com/img/big_shot-[[k % 6]].webp 2x"[[CASE WHEN k % 3 = 0 THEN ' alt="hero"' ELSE '' END]]><img src="https://CDN.example.com/img/teamPhoto_[[k % 4]].jpg"><img src="https://cdn.example.com/img/teamPhoto_[[k % 4]].JPG"><img src="/local/logo-[[k % 3]].svg" alt=""><img src="data:image/png;base64,AAAA">
<div style="background-image:url(https://cdn.example.com/bg[[k % 5]].jpg);padding:[[4 * (k % 5)]]px 10px">bg</div><video src="https://cdn.example.com/v[[k % 2]].mp4"></video><source src="https://cdn.example.com/s[[k % 2]].webm"><a href="/empty"> </a>
[[CASE k % 4 WHEN 0 THEN '<form action="mailto:a@x.com"><label>Your name</label><input type="text" name="name" required><label for="mail">Mail</label> <br><input type="email" name="mail" placeholder="Your mail"/><input type="hidden" name="token"><textarea name="msg"></textarea><button type="submit"> Send now </button></form>' WHEN 1 THEN '<input type="hidden" name="h"><input type="email" name="e" required><input placeholder="Phone"><button>Subscribe</button>' WHEN 2 THEN '<input type="text" name="q">' ELSE '' END]][[CASE WHEN k % 8 = 0 THEN '<form><input type="search" placeholder="Find"></form>' ELSE '' END]]
[[CASE k % 5 WHEN 0 THEN '<script>gsap.to(".a",{x:1});ScrollTrigger.create({});</script>' WHEN 1 THEN '<script>requestAnimationFrame(step);</script>' WHEN 2 THEN '<script>document.querySelector("#abc").style.color = "red"; console.log("done with it");</script>' WHEN 3 THEN '<div class="w-webflow-badge"></div>' ELSE '<div data-wix="1"></div>' END]]</div>"""


def _expression(template: str, key: str | None = "page_id") -> str:
    """`text [[sql]] text` as one SQL concat; `k` in the SQL parts stands for the key column."""
    out = []
    for i, part in enumerate(re.split(r"\[\[(.*?)\]\]", template, flags=re.S)):
        if i % 2:
            out.append("(" + (re.sub(r"\bk (?=[%*+])", f"{key} ", part) if key else part) + ")")
        elif part:
            out.append("'" + part.replace("\n", " ") + "'")
    return "concat(" + ", ".join(out) + ")"


STYLED_HTML_SQL = (
    f"concat(replace(html, '</head>', concat({_expression(_HEAD)}, '</head>')), {_expression(_BODY)})"
)


def styled_pages(pages: DataFrame) -> DataFrame:
    """`pages` with design markup added to every page."""
    return pages.select("page_id", "url", F.expr(STYLED_HTML_SQL).alias("html"))
