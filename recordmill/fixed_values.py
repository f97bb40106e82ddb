"""Fixed values.

Word lists, patterns and defaults whose exact content decides the results. They are data, kept
together in natural order; every rule that uses them lives elsewhere.
"""

# --- Character classes, written so that Java and RE2 read them alike -------------------------
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"

# --- Test-fixture markers, one list per audited table ----------------------------------------
FIXTURE_KEYWORDS = {
    "papers": ["test-paper-", "test_id=", "test_raw_", "test_checkpoint_", "paper/98456"],
    "products": ["test-product-", "test_id=", "test_raw_", "test_checkpoint_", "sample_product_"],
    "startups": ["test-startup-", "test_id=", "test_raw_", "test_checkpoint_", "sample_startup_"],
    "jobs": ["test-job-", "test_id=", "test_raw_", "test_checkpoint_", "sample_job_"],
    "news": [
        "test-paper-", "test-job-", "test-news-", "test_id=", "test_raw_", "test_checkpoint_",
        "example.com",
    ],
    "export": [
        "test-paper-", "test-job-", "test_id=", "test_raw_", "test_checkpoint_", "paper/98456",
    ],
    "inventory": ["test-paper-", "test_id=", "test_raw_", "test_checkpoint_"],
}
FORBIDDEN_EXPORT_TERMS = [
    "paperswithcode.co/paper/98456", "openai/gpt-4", "test-paper-", "test_id=", "test_raw_",
    "test_checkpoint_",
]

# --- Titles that count as AI stories ----------------------------------------------------------
AI_TITLE_TERMS = [
    "ai", "llm", "llms", "gpt", "gpt-4", "gpt-4o", "claude", "anthropic", "openai", "deepseek",
    "transformer", "neural", "machine learning", "deep learning",
]

# --- Entities looked for in news, in output order ---------------------------------------------
KNOWN_ENTITIES = [
    "OpenAI", "Anthropic", "NVIDIA", "Google", "DeepMind", "Microsoft", "Meta", "HuggingFace",
    "Mistral", "Cohere", "xAI", "Apple", "Amazon", "Scale AI", "Stability AI", "Perplexity",
    "LangChain", "Llama", "ChatGPT", "Claude", "Gemini", "GPT-4", "GPT-4o", "DeepSeek", "Qwen",
    "PyTorch", "TensorFlow", "CUDA",
]

# --- Job role families: first list with a hit wins --------------------------------------------
ROLE_FAMILIES = [
    ("Data Science", ["data science", "data scientist", "data analyst", "analytics"]),
    ("AI/ML", [
        "machine learning", "ml engineer", "ai engineer", "deep learning", "nlp", "cv",
        "computer vision", "ai/ml", "research scientist",
    ]),
    ("Product", ["product manager", "product owner", "product lead"]),
    ("Design", ["designer", "ui/ux", "ux designer", "product design"]),
    ("Management", ["engineering manager", "cto", "vp engineering", "lead engineer"]),
]
DEFAULT_ROLE_FAMILY = "Engineering"

# --- Repository owners that are site sections --------------------------------------------------
RESERVED_REPO_OWNERS = [
    "sponsors", "about", "features", "pricing", "security", "topics", "collections", "settings",
]

# --- Entity names -------------------------------------------------------------------------------
LEGAL_SUFFIXES = [
    "inc", "llc", "corp", "corporation", "ltd", "limited", "gmbh", "co", "company", "pbc", "plc",
]
DISTINGUISHING_WORDS = [
    "labs", "research", "capital", "records", "systems", "technologies", "services", "web",
]
# (type, name, normalised name, aliases, domains, external ids, source urls)
SEED_ENTITIES = [
    ("STARTUP", "OpenAI", "openai",
     ["Open AI", "OpenAI Inc.", "OpenAI, Inc.", "OpenAI LLC", "Open AI Inc"],
     ["openai.com"], {"crunchbase": "openai", "wikidata": "Q21708200"}, ["https://openai.com"]),
    ("STARTUP", "Anthropic", "anthropic", ["Anthropic PBC", "Anthropic AI"],
     ["anthropic.com"], {"crunchbase": "anthropic", "wikidata": "Q111167389"},
     ["https://anthropic.com"]),
    ("STARTUP", "Google", "google", ["Google LLC", "Google Inc."],
     ["google.com"], {"crunchbase": "google", "wikidata": "Q95"}, ["https://google.com"]),
    ("STARTUP", "Microsoft", "microsoft", ["Microsoft Corporation", "Microsoft Corp"],
     ["microsoft.com"], {"crunchbase": "microsoft", "wikidata": "Q2283"},
     ["https://microsoft.com"]),
    ("STARTUP", "Meta", "meta", ["Meta Inc.", "Meta Platforms", "Facebook Inc."],
     ["meta.com"], {"crunchbase": "meta", "wikidata": "Q380"}, ["https://meta.com"]),
    ("STARTUP", "NVIDIA", "nvidia", ["Nvidia Corp", "NVIDIA Corporation"],
     ["nvidia.com"], {"crunchbase": "nvidia", "wikidata": "Q182638"}, ["https://nvidia.com"]),
    ("STARTUP", "Apple", "apple", ["Apple Inc.", "Apple Computer"],
     ["apple.com"], {"crunchbase": "apple", "wikidata": "Q312"}, ["https://apple.com"]),
    ("STARTUP", "Amazon", "amazon", ["Amazon.com Inc.", "Amazon Inc."],
     ["amazon.com"], {"crunchbase": "amazon", "wikidata": "Q3884"}, ["https://amazon.com"]),
    ("STARTUP", "Mistral AI", "mistral ai", ["Mistral", "Mistral AI SAS"],
     ["mistral.ai"], {"crunchbase": "mistral-ai"}, ["https://mistral.ai"]),
    ("STARTUP", "Hugging Face", "hugging face", ["HuggingFace", "HuggingFace Inc."],
     ["huggingface.co"], {"crunchbase": "hugging-face"}, ["https://huggingface.co"]),
]

# --- Startup evidence ---------------------------------------------------------------------------
NON_STARTUP_TERMS = (
    "university|univ|college|school|faculty|polytechnic|academia|institute of technology|"
    "research group|academic|lab group|foundation|open source community|developer community|"
    "personal project|awesome-|curated list|learning resource|non-profit|nonprofit|government|"
    "gov|department of|association|society"
)
LEGAL_ENTITY_TERMS = (
    r"inc\.?|incorporated|corp\.?|corporation|ltd\.?|limited|gmbh|llc|c-corp|s-corp|"
    r"pvt\.?\s*ltd\.?|pte\.?\s*ltd\.?|b\.?v\.?|s\.?a\.?|co\.,?\s*ltd\.?|s\.?r\.?o\.?|a/s|ab|oy|"
    r"gmbh\s*&\s*co|kGaA"
)
COMMERCIAL_TERMS = (
    "company|startup|venture-backed|backed by|commercial|enterprise|platform|solution|solutions|"
    "service|services|provider|product|products|headquartered|software company|tech company|"
    "ai company|cloud platform|saas|developer tool|infrastructure|analytics|security company|"
    "data platform|automation|api|agents|build|deploy|scale|open source company|infra|database|"
    "storage"
)
SKIPPED_WEBSITES = [
    "twitter.com", "x.com", "t.me", "discord.gg", "github.io", "wikipedia.org", "medium.com",
    "youtube.com",
]
WEBSITE_ENDINGS = [
    ".com", ".ai", ".io", ".co", ".org", ".net", ".dev", ".app", ".tech", ".de", ".fr", ".uk",
    ".ca", ".us", ".jp", ".cn", ".in", ".eu", ".sh",
]

# --- Semantic classes -----------------------------------------------------------------------------
STARTUP_WORDS = [
    "inc", "corp", "ltd", "gmbh", "llc", "labs", "ai", "technologies", "platform", "company",
    "hq", "solutions", "software", "studio", "systems", "digital", "cloud", "data", "security",
    "group", "ventures", "interactive", "code", "dev",
]
PRODUCT_WORDS = [
    "framework", "tool", "platform", "agent", "engine", "app", "service", "model", "system",
    "sdk", "api",
]

# --- Crawl outcomes ---------------------------------------------------------------------------------
ANTI_BOT_MARKERS = [
    "cloudflare", "datadome", "captcha", "just a moment", "cf-ray", "access denied",
]
TRANSIENT_STATUSES = [408, 500, 502, 503, 504]

# --- HTML --------------------------------------------------------------------------------------------
NOISE_TAGS = ["script", "style", "nav", "footer", "header", "noscript", "iframe", "svg"]
META_DATE_KEYS = [
    ("property", "article:published_time"), ("property", "og:published_time"), ("name", "date"),
    ("name", "pubdate"), ("name", "publication_date"), ("name", "DC.date.issued"),
    ("itemprop", "datePublished"),
]
JSON_LD_DATE_KEYS = ["datePublished", "dateCreated", "dateModified", "datePosted"]

# --- URL canonical form -------------------------------------------------------------------------------
TRACKING_PARAMETERS = ["utm_source", "utm_medium", "utm_campaign", "gclid", "fbclid", "ref", "s"]

# --- Text budget ----------------------------------------------------------------------------------------
TRUNCATION_MARK = "\n\n[... TRUNCATED FOR CONTEXT WINDOW ...]\n\n"

# --- Job boards: field names and defaults ------------------------------------------------------------------
JOB_BOARDS = {
    "RemoteOKAI": {
        "title": "position", "title_default": "Software Engineer",
        "company": "company", "company_default": "Remote OK Client",
        "date": "date", "location": "location", "location_default": "Worldwide Remote",
        "description": "description", "remote_field": None, "strip": False,
    },
    "Arbeitnow": {
        "title": "title", "title_default": "Software Engineer",
        "company": "company_name", "company_default": "Arbeitnow Employer",
        "date": "created_at", "location": "location", "location_default": "Europe",
        "description": "description", "remote_field": "remote", "strip": True,
    },
    "Jobicy": {
        "title": "jobTitle", "title_default": "Remote Specialist",
        "company": "companyName", "company_default": "Jobicy Employer",
        "date": "pubDate", "location": "jobGeo", "location_default": "Remote",
        "description": "jobDescription", "remote_field": None, "strip": True,
    },
}
NEWS_FEEDS = {
    "TechCrunchAI": ("TechCrunch AI News", "TechCrunch AI News article"),
    "HuggingFaceDailyPapers": ("HuggingFace Daily Paper", "HuggingFace Daily Paper"),
    "MITTechReviewAI": ("MIT Technology Review AI", "MIT Technology Review AI article"),
    "OpenAIBlog": ("OpenAI News Announcement", "OpenAI News"),
}
STORY_TITLE = "Hacker News AI Story"
# Further names of the sources.
SOURCE_ALIASES = {
    "ArXiv": ("paperswithcode",),
    "GitHub Organizations": ("githuborgs", "startups"),
    "GitHub Repositories": ("githubproducts", "products"),
    "Hugging Face Models": ("hfmodels",),
    "RemoteOKAI": ("aijobsnet",),
    "Arbeitnow": ("ycworkatastartup", "jobs"),
    "Jobicy": ("cryptojobsai",),
}

# --- Export headers ---------------------------------------------------------------------------------------
EXPORT_TABS = {
    "startups": [
        ("ID", "id"), ("SchemaVersion", "schema_version"), ("SourceName", "source_name"),
        ("SourceURL", "source_url"), ("StartupName", "entity_name"),
        ("EmployeeCount", "employee_count"), ("FundingTotalUSD", "funding_total_usd"),
        ("CollectedAt", "collected_at"),
    ],
    "products": [
        ("ID", "id"), ("SchemaVersion", "schema_version"), ("SourceName", "source_name"),
        ("SourceURL", "source_url"), ("ProductName", "product_name"),
        ("StartupName", "startup_name"), ("PricingModel", "pricing_model"),
        ("CollectedAt", "collected_at"),
    ],
    "research_papers": [
        ("ID", "id"), ("ArXivID", "arxiv_id"), ("SchemaVersion", "schema_version"),
        ("SourceName", "source_name"), ("SourceURL", "source_url"), ("Title", "title"),
        ("NormalizedTitle", "normalized_title"), ("Authors", "authors"),
        ("PaperURL", "paper_url"), ("GitHubURL", "github_url"), ("GitHubStars", "github_stars"),
        ("PrimaryCategory", "primary_category"), ("Abstract", "abstract"),
        ("ContentHash", "content_hash"), ("EnrichmentStatus", "enrichment_status"),
        ("PublishedDate", "published_date"), ("CollectedAt", "collected_at"),
    ],
    "jobs": [
        ("ID", "id"), ("SchemaVersion", "schema_version"), ("SourceName", "source_name"),
        ("SourceURL", "source_url"), ("Company", "company"), ("PublishedDate", "published_date"),
        ("IsRemote", "is_remote"), ("RoleFamily", "role_family"), ("CollectedAt", "collected_at"),
    ],
    "news": [
        ("ID", "id"), ("SchemaVersion", "schema_version"), ("SourceName", "source_name"),
        ("SourceURL", "source_url"), ("Title", "title"), ("Summary", "summary"),
        ("PublishedDate", "published_date"), ("CollectedAt", "collected_at"),
    ],
    "entity_mappings": [
        ("ID", "id"), ("MappingID", "mapping_id"), ("EntityType", "entity_type"),
        ("RawValue", "raw_value"), ("NormalizedValue", "normalized_value"),
        ("CanonicalValue", "canonical_value"), ("Decision", "decision"),
        ("MatchMethod", "match_method"), ("Confidence", "confidence"),
        ("SourceURL", "source_url"), ("Timestamp", "timestamp"),
    ],
}

# --- Columns replaced when a known source_url arrives again; all others keep their first value ---------------
UPSERT_UPDATED = {
    "startups": ["entity_name", "employee_count", "data_json", "collected_at"],
    "products": ["product_name", "startup_name", "pricing_model", "data_json", "collected_at"],
    "research_papers": [
        "title", "github_stars", "abstract", "arxiv_id", "normalized_title", "primary_category",
        "data_json", "collected_at",
    ],
    "jobs": ["company", "published_date", "data_json", "collected_at"],
    "news": ["title", "summary", "published_date", "data_json", "collected_at"],
}
READABLE_TABLES = [
    "startups", "products", "research_papers", "jobs", "news", "canonical_entities",
    "entity_mappings", "dlq_records",
]

# Evidence text of a new entity.
NEW_ENTITY_REASON = "No existing canonical entity matched deterministic rules. Created new canonical record."
