"""Word lists of the entity rules. Results depend on them."""

LABELS = (
    "professional role", "industry sector", "technical method or standard", "programming language or framework",
    "operating system", "external software service", "file format", "hardware device",
)

OPERATING_SYSTEMS = {
    "android": "android", "ios": "ios", "ipados": "ipados", "linux": "linux", "mac os": "macos", "macos": "macos", "tvos": "tvos",
    "ubuntu": "ubuntu", "watchos": "watchos", "windows": "windows", "windows 10": "windows", "windows 11": "windows",
}

FILE_FORMATS = (
    "apk", "avif", "csv", "doc", "docx", "epub", "gif", "heic", "html", "ics", "jpeg", "jpg", "json", "markdown", "md", "mobi", "mov",
    "mp3", "mp4", "odp", "ods", "odt", "parquet", "pdf", "png", "ppt", "pptx", "psd", "rtf", "svg", "tiff", "tsv", "txt", "wav", "webm",
    "webp", "xls", "xlsx", "xml", "yaml", "yml", "zip",
)
FILE_PLURALS = {"gifs": "gif", "jpegs": "jpeg", "pdfs": "pdf"}
FILE_CANONICAL = {"md": "markdown", "yml": "yaml"}

TECHNOLOGIES = (
    "angular", "artificial intelligence", "asp.net", "aws", "azure", "bootstrap", "c", "c#", "c++", "chatgpt", "claude code", "cloudflare",
    "codex", "css", "dart", "deep learning", "django", "docker", "electron", "firebase", "flutter", "git", "github", "go", "graphql", "java",
    "javascript", "jquery", "kotlin", "kubernetes", "laravel", "machine learning", "mongodb", "mysql", "next.js", "node.js", "notion",
    "openai", "php", "postgresql", "python", "pytorch", "react", "react native", "redis", "ruby", "rust", "salesforce", "shopify", "slack",
    "sql", "stripe", "supabase", "swift", "tailwind", "tensorflow", "typescript", "vue", "web3", "wordpress", "zapier",
)
TECHNOLOGY_ALIASES = {"asp net": "asp.net", "next js": "next.js", "node js": "node.js"}
TECHNOLOGY_SCORE, TECHNOLOGY_SCORES = 0.68, {"c": 0.90, "go": 0.68, "java": 0.90}

INDUSTRIES = (
    "agriculture", "automotive", "banking", "construction", "cybersecurity", "e-commerce", "education", "energy", "finance", "fintech",
    "food", "government", "healthcare", "hospitality", "insurance", "legal", "logistics", "manufacturing", "marketing", "media",
    "nonprofit", "pharmaceutical", "real estate", "restaurants", "retail", "telemedicine", "telecommunications", "travel",
)
INDUSTRY_CANONICAL = {"e commerce": "e-commerce", "logistics": "logistics", "restaurants": "restaurant", "telecommunications": "telecommunications"}

GENERIC_SERVICES = (
    "ai", "api", "app", "application", "ats", "cdn", "chrome extension", "crm", "ease tools", "extension", "hosting provider", "mcp server",
    "online service", "online tool", "our service", "platform", "pwa", "rest api", "saas", "saas platform", "service", "software", "sftp",
    "telegram bot", "tool", "vpn", "we", "webdav", "webhooks", "website",
)
PLATFORMS = (
    "airbnb", "airtable", "amazon", "app store", "app store connect", "apple music", "asana", "aws", "aws lambda", "azure", "bitbucket",
    "box", "canva", "chatgpt", "claude", "claude ai", "claude code", "cloudflare", "deepseek", "discord", "docusign", "docker", "dropbox",
    "ebay", "etsy", "facebook", "facebook messenger", "figma", "firebase", "gemini", "github", "github actions", "github pages", "gitlab",
    "gmail", "google", "google ads", "google analytics", "google calendar", "google cloud", "google docs", "google drive", "google maps",
    "google meet", "google play", "google sheets", "google translate", "hacker news", "heroku", "hubspot", "icloud", "indeed", "instagram",
    "intercom", "itunes", "jira", "linkedin", "mailchimp", "make", "n8n", "netflix", "netlify", "notion", "obs", "onedrive", "openai",
    "patreon", "paypal", "pinterest", "play store", "reddit", "salesforce", "shopify", "slack", "soundcloud", "spotify", "steam", "strava",
    "stripe", "supabase", "telegram", "tiktok", "trello", "twitch", "twitter", "unsplash", "vercel", "vimeo", "webflow", "wetransfer",
    "whatsapp", "woocommerce", "wordpress", "youtube", "zapier", "zendesk", "zoom",
)

GENERIC_ROLES = (
    "agents", "business", "businesses", "companies", "company", "customer", "customers", "enterprise", "enterprises", "expert team",
    "freelance", "ghost writer", "owner", "owners", "people", "professional", "professionals", "pro", "pros", "role", "roles", "sales",
    "student", "students", "user", "users",
)
ROLE_NOUNS = (
    "accountant", "accountants", "admin", "admins", "advisor", "advisors", "analyst", "analysts", "animator", "animators", "architect",
    "architects", "artist", "artists", "bookkeeper", "bookkeepers", "cfo", "cmo", "coach", "coaches", "consultant", "consultants",
    "contractor", "contractors", "copywriter", "copywriters", "creator", "creators", "cto", "designer", "designers", "developer",
    "developers", "devs", "director", "drivers", "editor", "editors", "employee", "employees", "engineer", "engineers", "entrepreneur",
    "entrepreneurs", "founder", "founders", "freelancer", "freelancers", "manager", "managers", "marketer", "marketers", "mentor",
    "mentors", "operator", "operators", "photographer", "photographers", "recruiter", "recruiters", "researcher", "researchers",
    "scientist", "scientists", "specialist", "specialists", "teacher", "teachers", "technician", "technicians", "tester", "testers",
    "tutor", "tutors", "writer", "writers",
)
ROLE_ABBREVIATIONS = ("cfo", "cmo", "cto", "pm", "pms", "qa")
ROLE_QUALIFIERS = ("creative", "hr", "it", "sales", "seo")
ROLE_SINGULARS = {
    "accountants": "accountant", "admins": "admin", "advisors": "advisor", "analysts": "analyst", "animators": "animator",
    "architects": "architect", "artists": "artist", "bookkeepers": "bookkeeper", "coaches": "coach", "consultants": "consultant",
    "contractors": "contractor", "copywriters": "copywriter", "creators": "creator", "designers": "designer", "developers": "developer",
    "devs": "developer", "drivers": "driver", "editors": "editor", "employees": "employee", "engineers": "engineer",
    "entrepreneurs": "entrepreneur", "founders": "founder", "freelancers": "freelancer", "managers": "manager", "marketers": "marketer",
    "mentors": "mentor", "operators": "operator", "photographers": "photographer", "professionals": "professional",
    "recruiters": "recruiter", "researchers": "researcher", "scientists": "scientist", "specialists": "specialist", "teachers": "teacher",
    "technicians": "technician", "testers": "tester", "tutors": "tutor", "writers": "writer",
}

GENERIC_HARDWARE = (
    "ac", "board", "boards", "browser", "camera roll", "device", "devices", "dock", "hardware", "memory", "mobile", "notch", "samsung",
    "switch", "terminal", "vivo", "watch", "your phone",
)
HARDWARE_ALIASES = {
    "applewatch": "apple watch", "cameras": "camera", "chromebooks": "chromebook", "computers": "computer", "cpus": "cpu",
    "desktops": "desktop", "gpus": "gpu", "iphones": "iphone", "ipads": "ipad", "laptops": "laptop", "macs": "mac",
    "mobile devices": "mobile device", "mobile phones": "mobile phone", "pcs": "pc", "phones": "phone", "smartphones": "smartphone",
    "smartwatches": "smartwatch", "ssds": "ssd", "tablets": "tablet", "tvs": "tv",
}
