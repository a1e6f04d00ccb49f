"""Word lists, patterns and weights of the analyses.  Every operator takes them as parameters; these are the defaults."""

from __future__ import annotations

# Lists, patterns and weights that results depend on.
AD_MARKERS = ["brought to you by", "sponsored by", "promo code", "discount code", "visit our sponsor", "thanks to our sponsor", "ad break", "commercial break", "special offer", "limited time offer"]
POSITIVE = ["good", "great", "excellent", "amazing", "love", "best", "positive", "happy", "excited", "wonderful", "fantastic", "superior", "beneficial", "brilliant", "outstanding", "remarkable", "impressive", "delightful", "perfect", "enjoyable", "beautiful", "awesome", "incredible"]
NEGATIVE = ["bad", "terrible", "awful", "hate", "worst", "negative", "poor", "horrible", "failure", "inadequate", "disappointing", "problem", "wrong", "difficult", "unfortunate", "ugly", "nasty", "disaster", "pathetic", "inferior", "useless", "annoying", "frustrating"]
TECHNICAL_TERMS = {
    "medical": ["diagnosis", "symptom", "treatment", "pathology", "etiology", "prognosis", "therapeutic", "clinical", "pharmaceutical", "metabolism", "syndrome", "chronic", "acute", "inflammation"],
    "technology": ["algorithm", "framework", "architecture", "infrastructure", "optimization", "implementation", "protocol", "interface", "scalability", "latency", "throughput", "deployment", "microservice", "containerization", "orchestration"],
    "science": ["hypothesis", "methodology", "correlation", "causation", "empirical", "theoretical", "quantum", "molecular", "statistical", "systematic", "phenomenon", "paradigm"],
    "business": ["revenue", "margin", "equity", "valuation", "acquisition", "synergy", "leverage", "optimization", "monetization", "scalability", "disruption", "stakeholder", "portfolio"],
}
TECHNICAL_PATTERNS = {
    "medical_suffix": r"\b\w+(?:ology|itis|osis|ase|ide|ine)\b",
    "medical_prefix": r"\b(?:neuro|cardio|hypo|anti|meta|poly)\w+\b",
    "acronym": r"\b[A-Z]{2,}\b",
    "measurement": r"\b\d+\s*(?:mg|ml|μg|ng|mol|mM|μM|kg|g|L|mL)\b",
    "p_value": r"\bp\s*[<>=]\s*0\.\d+\b",
    "greek_letters": r"\b(?:alpha|beta|gamma|delta|epsilon|theta|lambda|sigma)\b",
    "bio_terms": r"\b(?:receptor|enzyme|protein|gene|pathway|mechanism|cell|tissue)\b",
    "research_terms": r"\b(?:hypothesis|theory|model|analysis|correlation|methodology)\b",
    "chemical_formula": r"\b[A-Z][a-z]?\d*(?:[A-Z][a-z]?\d*)*\b",
    "dna_sequence": r"\b[ATCG]{4,}\b",
}
FACT_PATTERNS = {
    "percentage": r"\b\d+(?:\.\d+)?%\b",
    "number": r"\b\d+(?:,\d{3})*(?:\.\d+)?\b",
    "study_findings": r"\b(?:study|research|survey|report|trial|experiment) (?:shows?|finds?|suggests?|indicates?|demonstrates?|reveals?)\b",
    "citation": r"\b(?:according to|based on|as per|cited in|reported by)\b",
    "evidence_words": r"\b(?:statistic|data|evidence|finding|result|outcome|conclusion)\b",
    "proof_words": r"\b(?:proven|demonstrated|established|confirmed|validated|verified)\b",
    "comparison": r"\b(?:compared to|versus|vs\.?|relative to|in contrast to)\b",
    "correlation": r"\b(?:correlated? with|associated with|linked to|related to)\b",
    "statistical": r"\b(?:significant|p-value|confidence interval|standard deviation|mean|median)\b",
}
QUOTE_PATTERNS = {
    "key_phrase": r"\b(?:the key|the secret|the most important|the main)\b",
    "absolute_terms": r"\b(?:always|never|every|all|none|nothing|everything)\b",
    "success_failure": r"\b(?:success|failure|mistake|lesson|achievement|accomplishment)\b",
    "belief_words": r"\b(?:believe|think|know|realize|understand|feel|assume)\b",
    "advice_pattern": r"\b(?:if you|when you|you should|you must|you need to|you can)\b",
    "transformation": r"\b(?:changed my|transformed|revolutionized|disrupted|shifted)\b",
    "quoted_text": r'"[^"]{10,200}"',
    "definition": r"\b(?:is|are|means?|refers? to|defined? as)\s+(?:that|to|when)?\b",
    "insight_intro": r"\b(?:what I learned|the insight|I realized|it turns out)\b",
}
ENTITY_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "url": r"https?://(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&//=]*)",
    "phone": r"\b(?:\+?1[-.]?)?\(?[0-9]{3}\)?[-.]?[0-9]{3}[-.]?[0-9]{4}\b",
    "date": r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2})\b",
    "time": r"\b\d{1,2}:\d{2}(?::\d{2})?(?:\s*[AP]M)?\b",
    "money": r"\$\d+(?:,\d{3})*(?:\.\d{2})?(?:\s*(?:million|billion|trillion|thousand|k|m|b))?\b",
    "person_name": r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b",
    "company_suffix": r"\b\w+\s*(?:Inc\.?|Corp\.?|LLC|Ltd\.?|Company|Co\.?)\b",
    "hashtag": r"#\w+",
    "mention": r"@\w+",
}
DOMAIN_PATTERNS = {
    "medical": {
        "diagnosis": r"\b(?:diagnosed with|diagnosis of|suffering from)\b",
        "symptoms": r"\b(?:symptoms?|signs?|presents? with|complains? of)\b",
        "treatment": r"\b(?:treated with|therapy|medication|procedure|surgery)\b",
        "dosage": r"\b\d+\s*(?:mg|ml|mcg|units?)\s*(?:daily|twice|three times|QD|BID|TID)\b",
    },
    "tech": {
        "programming": r"\b(?:API|SDK|framework|library|algorithm|function|method|class)\b",
        "architecture": r"\b(?:microservice|monolith|serverless|cloud|distributed|scalable)\b",
        "performance": r"\b(?:latency|throughput|bandwidth|optimization|cache|memory)\b",
        "version": r"\bv?\d+\.\d+(?:\.\d+)?(?:-[a-zA-Z0-9]+)?\b",
    },
    "business": {
        "metrics": r"\b(?:ROI|KPI|revenue|profit|margin|growth|market share)\b",
        "finance": r"\b(?:investment|valuation|equity|debt|capital|funding|IPO)\b",
        "strategy": r"\b(?:strategy|competitive advantage|market position|disruption)\b",
        "growth": r"\b\d+(?:\.\d+)?%\s*(?:growth|increase|decrease|decline)\b",
    },
}
JARGON_PATTERNS = [
    r"\b[A-Z]{3,}\b",
    r"\b\w+(?:ology|itis|osis|ase|ine|cyte|plasm)\b",
    r"\b(?:neuro|cardio|hypo|hyper|anti|meta|poly|mono|bi|tri)\w+\b",
    r"\b(?:algorithm|protocol|methodology|hypothesis|synthesis)\b",
    r"\b(?:receptor|enzyme|pathway|mechanism|substrate)\b",
]
EXPLANATION_PATTERNS = [
    r"\b(?:which means|in other words|that is|i\.e\.|for example|such as)\b",
    r"\b(?:basically|simply put|essentially|in simple terms)\b",
    r"\b(?:imagine|think of it as|like a?|similar to)\b",
    r"\([^)]+\)",
]
FACT_COUNT_PATTERNS = [
    r"\b\d+\s*(?:percent|%)",
    r"\b(?:study|research|experiment|trial)\s+(?:found|showed|demonstrated)",
    r"\b(?:according to|based on|research from)",
    r"\b(?:statistically|significantly|correlation)",
    r"\b\d{4}\b",
]
STOP_WORDS = (
    "the a an and or but in on at to for of with by from up about into through during before after above below between under is are "
    "was were been being have has had do does did will would should could may might must shall can need dare ought used i you he "
    "she it we they them their this that these those what which who whom whose when where why how all each every some any many much "
    "most other another such no nor not only own same so than too very s t just now"
).split()
LEADING_MARKERS = ["furthermore", "moreover", "additionally", "also", "speaking of which", "on that note", "similarly", "however", "on the other hand", "but", "alternatively", "anyway", "moving on", "let's shift to", "changing topics", "going back to", "as I was saying", "to return to"]
DISCOURSE_MARKERS = ["speaking of which", "on that note", "similarly", "however", "moving on", "furthermore", "in addition", "consequently", "therefore", "as a result", "in contrast", "meanwhile"]
SMOOTHNESS = {"continuation": 0.9, "expansion": 0.8, "return": 0.7, "pivot": 0.6, "jump": 0.3}
PLANNED = ["today we'll discuss", "let's talk about", "our topic is"]
DEEP = ["because", "therefore", "specifically", "in detail"]
MODERATE = ["for example", "such as", "including"]
PHASES = [("elaboration", ["explain", "detail", "describe"]), ("application", ["example", "instance", "case"]), ("challenge", ["however", "but", "challenge", "question"]), ("integration", ["connect", "relate", "together with"])]
RESOLUTION_WORDS = ["conclude", "summary", "therefore"]
INSIGHT_PHRASES = ["realize", "understand", "insight", "discovered", "learned"]
EMOTION_WORDS = ["amazing", "terrible", "love", "hate", "excited", "worried", "fantastic", "awful", "brilliant", "stupid"]
DETAIL = ["specifically", "in detail", "precisely", "exactly", "step by step", "broken down", "detailed"]
EXAMPLES = ["for example", "for instance", "such as", "like", "case in point", "consider", "take the case"]
ANSWERS = ["the answer", "that's because", "this means"]
RESOLUTION_SCORES = {"answered": 1.0, "partial": 0.7, "transformed": 0.6, "deferred": 0.5, "abandoned": 0.2}
PROBLEM = ["problem", "issue", "challenge", "difficulty", "concern"]
SOLUTION = ["solution", "solve", "fix", "address", "resolve"]
CONTRAST = ["however", "but", "although", "conversely", "on the other hand", "disagree"]
METAPHORS = {
    "journey": ["path", "road", "journey", "destination", "milestone", "crossroads"],
    "war": ["battle", "fight", "combat", "victory", "defeat", "strategy", "weapon"],
    "growth": ["grow", "seed", "bloom", "flourish", "root", "branch", "fertile"],
    "building": ["foundation", "build", "construct", "architect", "structure", "pillar"],
    "game": ["play", "rules", "win", "lose", "score", "team", "compete"],
    "machine": ["engine", "gear", "mechanism", "fuel", "drive", "operate"],
    "ecosystem": ["ecosystem", "environment", "evolve", "adapt", "balance", "symbiosis"],
}
QUOTE_TYPES = [
    ("opinion", ["believe", "think", "opinion", "perspective"]),
    ("factual", ["research", "study", "data", "evidence"]),
    ("humorous", ["funny", "hilarious", "joke"]),
    ("controversial", ["controversial", "debate", "disagree"]),
    ("insightful", ["insight", "realize", "understand", "learn"]),
]
QUOTE_SCORES = {"insightful": 0.2, "controversial": 0.15, "factual": 0.1, "opinion": 0.05, "humorous": 0.1, "general": 0.0}
PATTERN_KEYWORDS = {
    "causal": ["causes", "leads to", "results in", "drives", "impacts", "affects"],
    "tension": ["versus", "vs", "conflict", "tension", "opposing", "contrary", "debate"],
    "dependency": ["requires", "depends on", "needs", "prerequisite", "based on"],
    "emergence": ["emerges", "creates", "forms", "generates", "produces", "synthesis"],
}
NAME_SUFFIXES = [", inc.", ", inc", " inc.", " inc", ", llc", " llc", ", ltd", " ltd", ", corp", " corp", " corporation", " company", " & co", " & company"]
NAME_SUFFIXES_SHORT = [*NAME_SUFFIXES[:-1], " co."]
NAME_ABBREVIATIONS = [("&", "and"), ("u.s.", "us"), ("u.k.", "uk"), ("dr.", "doctor"), ("mr.", "mister"), ("ms.", "miss"), ("prof.", "professor")]
ALIAS_PATTERNS = [r"also known as ([^,\.]+)", r"formerly ([^,\.]+)", r"aka ([^,\.]+)", r"\(([^)]+)\)", r'or "([^"]+)"', r"or '([^']+)'"]
ALIASES = [
    ["ai", "artificial intelligence", "a.i."], ["ml", "machine learning"], ["nlp", "natural language processing"], ["llm", "large language model", "large language models"],
    ["api", "application programming interface"], ["ui", "user interface"], ["ux", "user experience"], ["db", "database"], ["os", "operating system"],
    ["cpu", "central processing unit", "processor"], ["gpu", "graphics processing unit", "graphics card"], ["ram", "random access memory", "memory"], ["ssd", "solid state drive"],
    ["hdd", "hard disk drive", "hard drive"], ["iot", "internet of things"], ["vr", "virtual reality"], ["ar", "augmented reality"], ["mr", "mixed reality"],
    ["ci", "continuous integration"], ["cd", "continuous deployment", "continuous delivery"], ["devops", "development operations"], ["poc", "proof of concept"],
    ["mvp", "minimum viable product"], ["roi", "return on investment"], ["kpi", "key performance indicator"], ["b2b", "business to business"], ["b2c", "business to consumer"],
    ["saas", "software as a service"], ["paas", "platform as a service"], ["iaas", "infrastructure as a service"],
]
ABBREVIATIONS = {
    "Dr.": "Doctor", "Mr.": "Mister", "Mrs.": "Missus", "Ms.": "Miss", "Prof.": "Professor", "CEO": "Chief Executive Officer", "CTO": "Chief Technology Officer", "CFO": "Chief Financial Officer",
    "COO": "Chief Operating Officer", "VP": "Vice President", "SVP": "Senior Vice President", "EVP": "Executive Vice President", "PhD": "Doctor of Philosophy", "MD": "Medical Doctor", "JD": "Juris Doctor",
    "MBA": "Master of Business Administration", "USA": "United States of America", "UK": "United Kingdom", "EU": "European Union", "UN": "United Nations", "WHO": "World Health Organization",
    "NASA": "National Aeronautics and Space Administration", "FBI": "Federal Bureau of Investigation", "CIA": "Central Intelligence Agency", "MIT": "Massachusetts Institute of Technology",
    "UCLA": "University of California Los Angeles", "NYU": "New York University",
}
IRREGULAR_PLURALS = {"person": "people", "child": "children", "man": "men", "woman": "women", "datum": "data", "index": "indices"}
IMPORTANCE_WEIGHTS = {"frequency": 0.15, "structural_centrality": 0.25, "semantic_centrality": 0.20, "discourse_function": 0.20, "temporal_dynamics": 0.10, "cross_reference": 0.10}
# Fixed values of theme analysis: terms, meanings and the sentences of its reports.
INTERACTION_PATTERNS = ["emergence", "synthesis"]
ABSTRACT_TERMS = ["concept", "system", "framework", "paradigm", "principle"]
POSITIVE_INDICATORS = ["success", "innovation", "growth", "opportunity", "benefit"]
NEGATIVE_INDICATORS = ["challenge", "risk", "concern", "problem", "threat"]
VALUE_TERMS = ["good", "bad", "right", "wrong", "should"]
METAPHOR_MEANINGS = {
    "journey": "underlying theme of progression and transformation",
    "war": "underlying theme of conflict and competition",
    "growth": "underlying theme of development and potential",
    "building": "underlying theme of construction and stability",
    "game": "underlying theme of strategy and competition",
    "machine": "underlying theme of efficiency and systems",
    "ecosystem": "underlying theme of interconnection and balance",
}
METAPHOR_DEFAULT = "recurring metaphorical pattern"
THEME_SENTENCES = {
    "emergence": "This theme emerges from the synthesis of multiple concepts",
    "tension": "This theme reflects underlying tensions in the discussion",
    "metaphor": "Recurring %s metaphors reinforce this theme",
    "crescendo": "The theme builds in importance throughout the discussion",
    "steady": "This theme maintains consistent presence",
    "validated": "Strong evidence supports this as a genuine emergent theme",
    "none": "Implicit theme detected through concept clustering",
}
NARRATIVE_PARTS = {
    "dominant": "The conversation implicitly explores %s",
    "crescendo": "with themes building in intensity",
    "steady": "with consistent thematic presence",
    "connected": "while connecting %d interrelated concepts",
    "implicit": "through largely implicit means",
}
DISCOURSE_DESCRIPTIONS = {
    "hierarchical": "Centralized discussion with dominant themes",
    "modular": "Multiple distinct topic clusters",
    "sequential": "Linear progression of ideas",
    "emergent": "Organic, exploratory conversation",
}
GAP_SUGGESTIONS = {
    "bridge": "Consider exploring how %s relates to both topic areas",
    "close": "These topics are semantically close - look for implicit connections",
    "distant": "These topics are semantically distant - bridging may reveal novel insights",
}
