"""Values that results depend on. Everything here is data, no logic."""

# HTML entities decoded in facts, and what each becomes.
HTML_ENTITIES = {
    "&amp;": "&",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "",
    "&copy;": "©",
    "&reg;": "®",
    "&trade;": "™",
    "&ndash;": "-",
    "&mdash;": "—",
    "&lsquo;": "`",
    "&rsquo;": "`",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&#8217;": "'",
    "&#8211;": "-",
    "&#8212;": "—",
}

# Conservation codes, and the phrases that stand for them.
# A phrase that contains another phrase comes before it.
CONSERVATION_CODES = ("LC", "NT", "VU", "EN", "CR", "EW", "EX", "DD", "NE")
CONSERVATION_PHRASES = (
    ("least concer", "LC"),
    ("near threatened", "NT"),
    ("vulnerable", "VU"),
    ("critically endangered", "CR"),
    ("endangered", "EN"),
    ("extinct in the wild", "EW"),
    ("extinct", "EX"),
    ("data deficient", "DD"),
    ("not evaluated", "NE"),
)

# Wiki headings that are not content.
IGNORED_HEADINGS = (
    "see also",
    "external links",
    "references",
    "sources",
    "further reading",
    "notes",
)

# Redirect targets that are not alternative titles.
IGNORED_REDIRECTS = ("other uses", "and")

# Keys whose leaves stay out of the full-text content.
CONTENT_SKIPPED_KEYS = ("match_type", "id", "uuid")

# Labels of the match rules, by code.
MATCH_RULE_LABELS = {
    1: "common_name == animal_name",
    2: "common_name in wiki alternatives",
    3: "common_name == parenthetical base",
    4: "alt == animal_name",
    5: "alt lists overlap",
    6: "alt == animal_name_base",
    7: "scientific in list",
    8: "scientific == taxon",
    9: "scientific == genus+species",
    10: "scientific == animal_name",
    11: "scientific == animal_name_base",
}

# Header of the crawl metadata file.
METADATA_HEADER = {
    "url": "URL",
    "status_code": "HTTP Status Code",
    "response_time": "Response Time (s)",
    "timestamp": "Crawl Timestamp",
    "title": "HTML Title",
    "canonical": "Canonical URL",
    "robots": "robots Directive",
    "content_type": "Content Type",
    "page_size_compressed": "Page Size (Raw/Compressed Bytes)",
    "page_size_uncompressed": "Page Size (Uncompressed Bytes)",
}

# Limits.
FIELD_TERM_MAX_CHARS = 100
SNIPPET_MAX_CHARS = 160
BM25_K1 = 1.2
BM25_B = 0.75

# Patterns (Java regex; the last two groups need Unicode classes).
LINK_PATTERN = r"""(?id)<a[^>]+href=['"](.*?)['"][^>]*>"""
HEADER_NAV_PATTERN = r"""(?is)<div[^>]*id=["']headerNav["'][^>]*>.*?</div>"""
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"
CANONICAL_PATTERN = r"""(?id)<link[^>]+rel=["']canonical["'][^>]+href=["'](.*?)["']"""
ROBOTS_PATTERN = r"""(?id)<meta[^>]+name=["']robots["'][^>]+content=["'](.*?)["']"""
BINOMIAL_PATTERN = r"(?U)\b([A-Z][a-z]+\s+[a-z][a-z\-]+(?:\s+[a-z][a-z\-]+)?)\b"
H2_PATTERN = r"(?mU)^\s*==\s*([^=\n].*?)\s*==\s*$"

# Patterns of wikitext (Java regex).
PIPED_LINK_PATTERN = r"\[\[[^\]|]+\|([^\]]+)\]\]"
REF_AND_TAG_PATTERNS = (r"(?i)<ref[^>]*?/\s*>", r"(?is)<ref[^>]*?>.*?</ref>", r"<[^>]+>")
FILE_LINK_PATTERN = r"(?i)\[\[(?:File|Image):[^\]]+\]\]"
CATEGORY_PATTERN = r"(?i)\[\[Category:([^\]]+)\]\]"
TITLE_VALUE_PATTERN = r"(?iU)\btitle\s*=\s*([^|{}\n\r]+)"
REDIRECT_NOTE_PATTERN = r"(?s)\{\{\s*[Rr]edirect\s*\|([^}]+)\}\}"
ONE_ARGUMENT_TEMPLATE_PATTERN = r"\{\{[^|{}]*\|([^{}]*)\}\}"
SYNONYM_WORD_PATTERN = r"(?iU)\bsynonym\w*\b"
ITALICS_PATTERN = r"''+([^']{1,200})''+"

# Patterns of the pages of one site that facts are read from (Java regex).
H1_PATTERN = r"(?i)<h1[^>]*>([^<]+)</h1>"
TITLE_HEADER_H1_PATTERN = r'(?is)<div\s+id="title-header"[^>]*>.*?<h1[^>]*>([^<]+)</h1>'
TITLE_HEADER_NAME_PATTERN = (
    r'(?is)<div\s+id="title-header"[^>]*>.*?<p[^>]*class="[^"]*text-white[^"]*"[^>]*>'
    r"\s*([A-Z][a-z]+\s+[a-z]+)\s*</p>"
)
MAIN_TEXT_PATTERNS = (
    r"""(?is)<div[^>]+id=["']single-animal-text["'][^>]*>(.*?)<div[^>]+id=["']single-animal-sidebar["']""",
    r"""(?is)<div[^>]+id=["']single-animal-text["'][^>]*>(.*)</div>\s*</div>\s*</div>""",
)
SECTION_PATTERN = r"(?is)(<h2[^>]*>.*?</h2>.*?)(?=<h2[^>]*>|\z)"
SECTION_PARTS_PATTERN = r"(?is)^<h2[^>]*>(.*?)</h2>(.*)$"
PARAGRAPH_PATTERN = r"(?is)<p[^>]*>(.*?)</p>"
LINKED_ITEM_PATTERN = r"(?i)<li><a[^>]*>([^<]+)</a></li>"
CLASSED_ITEM_PATTERN = r'(?i)<li[^>]*class="[^"]*list-item[^"]*"[^>]*>([^<]+)</li>'
CONSERVATION_PATTERN = r"(?is)<h2[^>]*>.*?Conservation Status</h2>.*?<li><a[^>]*>([^<]+)</a></li>"
LOCATIONS_PATTERN = r"(?is)<h2[^>]*>.*?Locations</h2>.*?<ul[^>]*>(.*?)</ul>"
FACTS_URL_PATTERN = r'(?i)<link\s+rel="canonical"\s+href="([^"]+)"\s*/>'
NAME_BREAKS_PATTERN = r"(?i),|/|[|]|;|\band\b"
