"""Rules as data. Every operator takes them as parameters with these values as defaults."""

# Hosts by platform.
PLATFORM_HOSTS = {
    "instagram": ("instagram.com", "www.instagram.com", "m.instagram.com"),
    "tiktok": ("tiktok.com", "www.tiktok.com", "m.tiktok.com"),
    "x": ("x.com", "www.x.com", "twitter.com", "www.twitter.com"),
    "facebook": ("facebook.com", "www.facebook.com", "m.facebook.com", "fb.watch"),
    "linkedin": ("linkedin.com", "www.linkedin.com"),
    "youtube": ("youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be"),
    "pinterest": ("pinterest.com", "www.pinterest.com"),
}
SOCIAL_HOSTS = tuple(h for hosts in PLATFORM_HOSTS.values() for h in hosts)
SLASH_HOSTS = PLATFORM_HOSTS["instagram"]
KEEP_QUERY = {h: ("v", "list") for h in ("youtube.com", "www.youtube.com", "m.youtube.com")}

# Parameters that may hold the real destination, in order of priority.
WRAPPER_PARAMS = ("url", "u", "target", "dest", "destination", "redirect", "redirect_url", "redirect_uri", "r", "to", "link", "href")

# Tracking parameters, compared in lower case.
DROP_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_name", "utm_id", "utm_reader", "utm_viz_id",
    "utm_pubreferrer", "utm_swu", "fbclid", "gclid", "igsh", "si", "feature", "mibextid", "mc_cid", "mc_eid", "trk", "trkinfo",
    "midtoken", "lipi", "li_fat_id", "guccounter", "guce_referrer", "guce_referrer_sig", "ncid", "ref_src", "ref_url", "s", "t",
)

# Endings of assets.
ASSET_ENDINGS = ("gif", "jpg", "jpeg", "png", "webp", "svg", "ico", "css", "js", "woff", "woff2", "ttf", "map", "xml")

# Texts of posts that can't be seen.
UNAVAILABLE = (r"post isn.?t available", r"profile isn.?t available", r"link may he broken", r"link may be broken", r"profile may have been removed", r"log in")

# Allowed values of model replies.
CONFIDENCES = ("high", "medium", "low")
PROMPT_TYPES = (
    "Job_Seeking", "Personal_Improvement", "Learning_Aid", "Money_Maker", "Business_Tips", "Developer_Coding_Aid", "Dark-Forbidden-Illegal",
    "Image_Generation", "Video_Generation", "Humanize_Text", "Teraphy-Psychology-Self-Analysis", "Other_Non_classified_Miscellaneous",
)
MODALITIES = ("chat", "text", "image", "video", "sound", "music", "presentation", "code", "spreadsheet", "formula", "chart", "report", "app_code")
ENGINES = ("all_models", "chatgpt", "claude", "gemini", "grok", "midjourney", "flux", "qwen", "wan", "runway", "sora", "gamma", "gemma", "stable_diffusion", "dalle", "excel", "google_sheets")
COMMENT_TAGS = (
    "PROMPT_EXTRACTED", "MULTI_SLIDE_PROMPT_MERGED", "INTRO_SLIDE_IGNORED", "CTA_REMOVED", "BRANDING_REMOVED", "QUOTE_SLIDE_IGNORED",
    "OCR_ARTIFACTS_PRESENT", "PROMPT_INCOMPLETE", "LOW_CONFIDENCE_SOURCE", "NO_PROMPT_FOUND",
)

MANDATORY = ("prompt_unique_id", "prompt_text_original", "prompt_text_clean", "prompt_type", "target_engine", "output_modality", "prompt_size_chars", "record_status")
MAX_SLIDES = 20
