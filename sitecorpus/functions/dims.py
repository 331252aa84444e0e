"""Lists, dictionaries and thresholds the results depend on."""

# Elements that never have a closing tag (HTML standard).
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
)

# Tracking hosts, matched by substring of the request host.
SHARED_TRACKING_HOSTS = (
    "sentry.io", "www.googletagmanager.com", "connect.facebook.net", "stats.g.doubleclick.net", "google-analytics.com",
)
PLATFORM_TRACKING_HOSTS = {
    "framer": ("events.framer.com", "api.framer.com", "collect.frameranalytics.com"),
    "webflow": ("js-agent.newrelic.com", "cdn.heapanalytics.com", "tr.snapchat.com"),
    "wix": ("frog.wix.com", "bi.wixapi.com", "fed.wixcodescheduler.com", "editor.wix.com", "panorama.wixapps.net"),
}

# Site builders in detection order, URL pattern and any-of HTML markers (regular expressions).
PLATFORM_RULES = (
    ("framer", 1, "url", r"\.framer\.(app|website)|framercanvas\.com"),
    ("webflow", 2, "url", r"\.webflow\.(io|com)"),
    ("wix", 3, "url", r"\.wixsite\.com|\.wix\.com"),
    ("webflow", 5, "html", r"data-wf-site|w-webflow-badge|Webflow|webflow\.js"),
    ("wix", 6, "html",
     r"wix-viewer-model|id=\"WIX_ADS\"|X-Wix-|Wix\.com|wixcode-sdk|data-wix|wix-code|WixCode|\bwix\.com\b|(?i:_wix_)|(?i:wix-ecom)"),
)
# Framer needs two markers on the same page (priority 4, between its URL rule and the other markers).
FRAMER_MAIN_MARKER = 'id="main"'
FRAMER_HOST_MARKER = r"framerstatic\.com|framerusercontent\.com"

# Markup removed before a page is analysed; name -> pattern.
STRIP_RULES = (
    ("integrity", r'\s+integrity="[^"]*"'),
    ("crossorigin", r'\s+crossorigin(?:="[^"]*")?'),
    ("preconnect", r'<link[^>]*rel="(?:preconnect|dns-prefetch)"[^>]*>'),
    ("csp", r"(?i)<meta[^>]*content-security-policy[^>]*>"),
    ("framer_badge", r'<div id="__framer-badge-container"[^>]*></div>'),
    ("webflow_badge", r'(?s)<a[^>]*class="[^"]*w-webflow-badge[^"]*"[^>]*>.*?</a>'),
    ("wix_ads", r'(?s)<div[^>]*class="[^"]*wix-ads[^"]*"[^>]*>.*?</div>'),
    ("ad_block", r'(?s)<div class="ad">.*?</div>'),
)

# Colour-bearing CSS properties.
COLOR_PROPS = (
    "color", "background-color", "background", "border-color", "border-top-color", "border-right-color",
    "border-bottom-color", "border-left-color", "outline-color", "text-decoration-color", "fill", "stroke",
)

# Context names given to the font sizes of a site, largest first.
SIZE_CONTEXTS = ("H1", "H2", "H3", "H4", "H5", "Body", "Small", "XSmall")

# CSS easing to builder easing; anything else becomes the default.
EASING = {
    "ease": "ease", "ease-in": "ease-in", "ease-out": "ease-out", "ease-in-out": "ease-in-out", "linear": "linear",
    "cubic-bezier(0.4, 0, 0.2, 1)": "ease-out", "cubic-bezier(0, 0, 0.2, 1)": "ease-out", "power2.out": "ease-out",
    "power2.in": "ease-in", "power2.inOut": "ease-in-out", "power4.out": "ease-out", "none": "linear",
}
DEFAULT_EASING = "ease-out"

# Animated property to effect; anything else counts as opacity.
EFFECTS = {
    "opacity": "fade", "translateY": "slide-up", "translateX": "slide-left", "scale": "zoom", "rotate": "rotate",
}

# Animation-library plugins looked for in scripts.
GSAP_PLUGINS = (
    "ScrollTrigger", "SplitText", "ScrollToPlugin", "Flip", "Observer", "Draggable", "MotionPathPlugin",
)

# Font weight names.
WEIGHT_NAMES = {
    100: "Thin", 200: "ExtraLight", 300: "Light", 400: "Regular", 500: "Medium", 600: "SemiBold", 700: "Bold",
    800: "ExtraBold", 900: "Black",
}

# Viewport classes, (name, widest max-width, narrowest min-width).
MOBILE_MAX = 809
DESKTOP_MIN = 1200

# Expected design breakpoints and tolerance in px.
EXPECTED_BREAKPOINTS = {"tablet": 810, "mobile": 390}
BREAKPOINT_TOLERANCE = 10

# Mime type by file extension.
MIME = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp",
    "avif": "image/avif", "svg": "image/svg+xml", "ico": "image/x-icon", "mp4": "video/mp4", "webm": "video/webm",
    "woff2": "font/woff2", "woff": "font/woff", "ttf": "font/ttf", "otf": "font/otf", "css": "text/css",
    "js": "application/javascript", "json": "application/json",
}

# Error message patterns.
METHOD_MISSING_PATTERN = r"method.*not found|read_page|does not exist"
RETRYABLE_WORDS = ("fetch failed", "network", "econnrefused", "enotfound", "etimedout", "econnreset")

# Premium widget names and the plain widget that stands in, in matching order.
PRO_WIDGETS = (
    ("loop-grid", "e-flexbox", True), ("posts", "e-flexbox", True), ("form", "e-flexbox", False),
    ("nav-menu", "e-flexbox", True), ("mega-menu", "e-flexbox", True), ("search-form", "e-flexbox", False),
    ("price-table", "e-flexbox", True), ("slide", "e-flexbox", False), ("countdown", "e-paragraph", True),
    ("theme-template", "e-flexbox", True), ("popup", None, False), ("login", "e-flexbox", False),
)
