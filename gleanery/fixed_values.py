"""Fixed values.

Word lists, constants, patterns and formats below decide results and must keep exactly
these values and this order.
"""

# Section headings, by section, in the order in which sections are tried.
RESPONSIBILITY_HEADINGS = [
    "responsibilities",
    "key responsibilities",
    "responsibility",
    "what you'll do",
    "what you will do",
    "what you do",
    "your role",
    "岗位职责",
]
SKILL_HEADINGS = [
    "skills",
    "required skills",
    "desired skills",
    "skills & qualifications",
    "skill requirements",
    "岗位技能",
]
REQUIREMENT_HEADINGS = [
    "requirements",
    "qualifications",
    "must have",
    "nice to have",
    "experience",
    "岗位要求",
]

# Substrings that route a line outside any section.
RESPONSIBILITY_HINTS = ["responsib"]
SKILL_HINTS = ["skill", "competenc", "能力"]
REQUIREMENT_HINTS = ["require", "qualif", "experience", "要求"]

# Lead-ins and endings cut from a skill phrase.
SKILL_PREFIXES = [
    "experience with",
    "experience in",
    "experience using",
    "experience working with",
    "experience working in",
    "knowledge of",
    "knowledge in",
    "knowledge with",
    "proficiency in",
    "proficiency with",
    "proficiency using",
    "expertise in",
    "expertise with",
    "familiarity with",
    "familiarity in",
    "ability to",
    "capability to",
    "responsible for",
    "strong knowledge of",
    "strong understanding of",
    "hands-on experience with",
    "hands-on experience in",
]
SKILL_SUFFIXES = [" skills", " skill", " expertise"]
SKILL_STRIP_CHARS = " -•\t\r\n.:;"
LINE_STRIP_CHARS = " -*•\t"
MAX_SKILL_CHARS = 80
MAX_SKILL_WORDS = 8

# Phrases looked for in a whole description.
SKILL_PHRASES = [
    "machine learning",
    "deep learning",
    "data science",
    "data analysis",
    "statistical modeling",
    "predictive analytics",
    "natural language processing",
    "computer vision",
    "cloud computing",
    "distributed systems",
    "big data",
    "project management",
    "product management",
    "stakeholder management",
    "requirements gathering",
    "user research",
    "business intelligence",
    "performance optimization",
    "process automation",
    "risk management",
    "quality assurance",
    "change management",
    "test automation",
    "continuous integration",
    "continuous delivery",
    "model deployment",
    "microservices architecture",
    "data visualization",
    "feature engineering",
    "security compliance",
    "incident management",
    "capacity planning",
    "workflow automation",
    "talent development",
    "go-to-market strategy",
    "customer success",
    "vendor management",
]

# Single words and the spelling they are reported in.
SKILL_WORDS = {
    "python": "Python",
    "java": "Java",
    "javascript": "JavaScript",
    "typescript": "TypeScript",
    "golang": "Go",
    "go": "Go",
    "sql": "SQL",
    "nosql": "NoSQL",
    "hadoop": "Hadoop",
    "spark": "Spark",
    "kafka": "Kafka",
    "airflow": "Airflow",
    "aws": "AWS",
    "azure": "Azure",
    "gcp": "GCP",
    "docker": "Docker",
    "kubernetes": "Kubernetes",
    "terraform": "Terraform",
    "ansible": "Ansible",
    "linux": "Linux",
    "git": "Git",
    "jira": "Jira",
    "figma": "Figma",
    "photoshop": "Photoshop",
    "tableau": "Tableau",
    "powerbi": "Power BI",
    "excel": "Excel",
    "snowflake": "Snowflake",
    "redshift": "Redshift",
    "postgresql": "PostgreSQL",
    "mysql": "MySQL",
    "oracle": "Oracle",
    "sap": "SAP",
    "salesforce": "Salesforce",
    "servicenow": "ServiceNow",
    "scala": "Scala",
    "r": "R",
    "matlab": "MATLAB",
    "pytorch": "PyTorch",
    "tensorflow": "TensorFlow",
    "keras": "Keras",
    "scikitlearn": "scikit-learn",
    "sparkml": "Spark ML",
    "html": "HTML",
    "css": "CSS",
    "rest": "REST",
    "graphql": "GraphQL",
    "ci": "CI",
    "cd": "CD",
    "mlops": "MLOps",
    "devops": "DevOps",
    "nlp": "NLP",
    "ai": "AI",
    "ml": "ML",
    "ui": "UI",
    "ux": "UX",
}
SKILL_TOKEN_PATTERN = r"(?U)\b[A-Za-z][A-Za-z0-9\+#\.\-/]{1,}\b"
SKILL_TOKEN_STRIP_CHARS = "-./"
ACRONYM = "[A-Z0-9]{2,5}"
# A word of a job title.
TITLE_WORD = r"[A-Z][A-Za-z0-9\-&/]+"
HASHTAG_PATTERN = r"#([A-Za-z0-9][A-Za-z0-9_\-]+)"

# Job titles.
TITLE_HINTS = [
    "job title",
    "title",
    "position",
    "role",
    "opportunity",
    "opening",
    "hiring",
    "we're hiring",
    "seeking",
    "looking for",
    "vacancy",
]
TITLE_ROLES = [
    "Engineer",
    "Specialist",
    "Manager",
    "Director",
    "Lead",
    "Designer",
    "Developer",
    "Consultant",
    "Analyst",
    "Architect",
    "Scientist",
    "Executive",
    "Officer",
]
MAX_TITLE_LINE_CHARS = 120

# Feed scan and feed cleaner.
FEED_COLUMNS = [
    "feed_title",
    "feed_xml_url",
    "feed_html_url",
    "entry_title",
    "entry_author",
    "entry_url",
    "published",
    "categories",
    "matched_keywords",
    "article_text",
]
DEFAULT_KEYWORDS = ["ai"]
MAX_ITEMS_PER_FEED = 50
MIN_YEAR = 2024
MIN_CHARS = 100
MAX_FIELD_CHARS = 10_000_000

# Job search.
JOB_COLUMNS = [
    "search_query",
    "title",
    "company",
    "location",
    "published_at",
    "url",
    "responsibilities",
    "skills",
    "requirements",
    "description",
]
DEFAULT_TITLE_QUERY = (
    '(("AI" OR "artificial intelligence" OR "machine learning" OR '
    '"deep learning" OR "generative AI" OR "AI strategy" OR "AI governance"))'
)
WORK_TYPES = ["1", "2", "3"]
CONTRACT_TYPES = ["F", "P", "C", "T", "I", "V"]
EXPERIENCE_LEVELS = ["1", "2", "3", "4", "5"]

# Blog listing.
BLOG_BASE_URL = "https://www.engblogs.dev"
SHORT_DATE_PATTERN = r"(?U)\b\d{1,2}/\d{1,2}/\d{4}\b"
DROPPED_BLOCKS = ["script", "style", "noscript", "pre", "code", "samp", "kbd"]
MIN_PARAGRAPH_WORDS = 3

# Post snapshots.
POST_COLUMNS = [
    "Post_ID",
    "Post_URL",
    "Post_Author_Name",
    "Post_Author_Profile",
    "Post_Author_JobTitle",
    "Post_Time",
    "Post_Content",
    "Post_Reactions",
    "Post_Comments",
    "Post_Impressions",
    "Date_Collected",
    "Job_Titles",
    "Job_Responsibilities",
    "Job_Skills",
    "Job_Requirements",
]
POST_ID_MARKER = "urn:li:activity:"
POST_SITE = "https://www.linkedin.com"
POST_CARD_CLASS = "feed-shared-update-v2"
POST_LINK_CLASS = "update-components-mini-update-v2__link-to-details-page"
POST_ACTOR_CLASS = "update-components-actor__container"
POST_ACTOR_TITLE_CLASS = "update-components-actor__title"
POST_ACTOR_LINK_CLASS = "update-components-actor__meta-link"
POST_ACTOR_JOB_CLASS = "update-components-actor__description"
POST_ACTOR_TIME_CLASS = "update-components-actor__sub-description"
POST_TEXT_CLASS = "update-components-text"
POST_COUNTS_CLASS = "social-details-social-counts"
POST_REACTIONS_CLASS = "social-details-social-counts__reactions"
POST_COMMENTS_CLASS = "social-details-social-counts__comments"
POST_IMPRESSIONS_CLASS = "analytics-entry-point"
MAX_IDLE_PASSES = 3

# Press articles.
PRESS_COLUMNS = [
    "search_text",
    "highlights",
    "region_id",
    "profile_id",
    "issue_id",
    "issue_title",
    "issue_date",
    "issue_country",
    "issue_cid",
    "page",
    "page_name",
    "section",
    "title",
    "subtitle",
    "hyphenated_title",
    "language",
    "authors",
    "byline",
    "is_top_article",
    "rank",
    "rate",
    "similars_count",
    "current_text_length",
    "total_text_length",
    "classification_tags",
    "related_titles",
    "images",
    "article_url",
    "article_text",
]
PRESS_ARTICLE_BASE = "https://www.pressreader.com/article/"

# Text enrichment requests.
TEXTS_PER_REQUEST = 5
MAX_REQUEST_CHARS = 4000
NO_DESCRIPTION = "(description not provided)"
SKILL_REQUEST_TEXT = (
    "For each numbered job description below, list the distinct skills a candidate must possess. "
    "Respond with a JSON array where each element corresponds to the matching job description order. "
    "Each element must be an array of concise skill strings. Use an empty array if no skills are present. "
    "Avoid explanations and keep skill names short."
)
INSIGHT_REQUEST_LINES = [
    "Extract structured job information from each LinkedIn post below.",
    "For every CONTENT block return four arrays: job_titles, responsibilities, skills, requirements.",
    "Infer information when reasonable. Treat explicit titles (e.g. ‘Senior Cloud & AI Platform Specialist’) or clear hiring phrases as job_titles.",
    "Responsibilities should be short action phrases (e.g. 'unlock the full potential of Azure and AI').",
    "Skills include technologies, tools, methodologies, or hashtags that imply competencies (convert hashtags into readable phrases).",
    "Requirements capture qualifications or traits implied as necessary (e.g. 'curiosity', 'collaboration').",
    "If a category is not present leave the array empty. Keep responses concise.",
    "Respond strictly with a JSON array of length N where element i corresponds to CONTENT i.",
]
