"""What a run is about: lexicon, patterns, windows and thresholds. Operators take a Profile; none of it is in their code."""

from __future__ import annotations

from dataclasses import dataclass, field


def words(*alternatives: str) -> str:
    """A pattern for any of the alternatives as whole words, in Java's Unicode-aware, case-insensitive mode."""
    return r"(?iuU)\b(" + "|".join(alternatives) + r")\b"


def anywhere(*alternatives: str) -> str:
    return "(?iu)(" + "|".join(alternatives) + ")"


EVENT_WORDS = words(
    "aguaceros?", "alagamento", "alagou", "avenida", "chuvas", "cheias?", "crecida", "crecientes", "desborde", "desbordamiento", "desbordó", "deslizamiento", "encharcamiento",
    "enchentes?", "flood", "huaico", r"emergencia\s+h[íi]drica", "inundaci[oó]n", "inundaciones", "inundaç[aã]o", "invernal", "lluvias?", r"ola\s+invernal", "precipitaci[oó]n", "riada", "temporal", "tormenta", "transbordou",
)


@dataclass(frozen=True)
class Profile:
    # windows, in days
    pre_days: int = 5
    post_days: int = 45
    post_days_long: int = 21
    long_duration: int = 20
    late_skip_days: int = 60
    late_post_days: int = 150
    nearest_gap_days: int = 120
    # pointers
    min_bytes: int = 500
    max_bytes: int = 5_000_000
    filename: str = r"^crawl-data/CC-MAIN-[0-9]{4}-[0-9]{2}/segments/.+[.]warc[.]gz$"
    cached_share: float = 0.95
    # documents
    min_chars: int = 200
    max_non_ascii: float = 0.4
    error_titles: tuple[str, ...] = ("Access Denied", "Error", "403", "404")
    boilerplate: tuple[str, ...] = ("accept cookies", "advertisement\\b", "click here\\b", "cookie", "follow us\\b", "loading\\.\\.\\.", "newsletter\\b", "read more\\b", "share this\\b", "sign up\\b", "subscribe\\b")
    always_languages: tuple[str, ...] = ("eng", "fra", "por", "spa")
    spec_languages: tuple[str, ...] = ("eng", "por", "spa")
    fallback_languages: tuple[str, ...] = ("eng", "fra")
    tier1: frozenset[str] = frozenset("arb ben cmn deu eng fas fra hin ind ita jpn kor por prs spa tha urd vie yue zlm".split())
    tier2: frozenset[str] = frozenset("afr ber bos bul ckb hat hrv kat khm lao mya npi pus ron sna srp tgl ukr".split())
    tier3: frozenset[str] = frozenset("ayu hau ibo kon lin lua lug men mlg mnk nya que sag som swa tem tsn wol xho yor zul".split())
    tracking: frozenset[str] = frozenset("cmpid fbclid ftag hss_channel intcmp mod partner ref related share source traffic_source utm_campaign utm_content utm_medium utm_source utm_term via".split())
    #: Where an event whose country has no list is searched for.
    fallback_domains: tuple[str, ...] = ("disasteralert.pfh.org", "floodlist.com", "gdacs.org", "ifrc.org", "preventionweb.net", "reliefweb.int", "unocha.org")
    #: What a broad look for the subject goes by.
    broad_words: str = words("cheias?", "crecidas?", "enchentes?", "flash floods?", "flood(s|ed|ing)?", "inondations?", "inundaci[oó]n(es)?", "riadas?")
    # caps of index hits by domain, and domains of national scope that get the smaller one
    hit_cap: int = 3000
    national_hit_cap: int = 500
    # gates: each a pattern of URLs or titles that are no article
    junk_host: str = r"(?i)^https?://(www\.)?weather\.gov(/|$)"
    listing_url: str = anywhere(
        "/(archives?|buscar|categor(y|ies)|etiqueta|kategori|opac|pencarian|recherche|rubri(c|que)|search|sections?|suche|tags?|topics?)/", "/tags?$", "/page/[0-9]+", "[_-]page[_-][0-9]+",
        r"[?&](page|p)=[0-9]+", r"[?&](keyword|query|q|s)=", "/[0-9]{4}/([0-9]{2}/)?$", ";jsessionid=", "/BrowseThesaurus",
    )
    prefilter_url: str = anywhere("/(archives?|buscar|categor(y|ies)|recherche|search|tags?|topics?)/", "/tags?$", "/page/[0-9]+", r"[?&]page=[0-9]+", r"[?&](keyword|query|q|s)=")
    home_url: str = r"^https?:/{2}[^/]+/?$"
    home_url_query: str = r"^https?:/{2}[^/]+/?(\?.*)?$"
    listing_title: str = anywhere(
        r"\bpage\s+[0-9]+\b", r"halaman\s+[0-9]+", r"^[a-z]+ [0-9]{1,2},?\s+[0-9]{4}\s*[-=—]", r"^[0-9]{4}\s+archives?\b", r"\barchives?\s+[0-9]{4}", r"\ball articles tagged\b", r"\btag:\s*",
        "berita terbaru .+ hari ini$", "berita (dan informasi|tentang) .+ terkini", "informasi .+ terkini dan terbaru", r"^[0-9]+\.[0-9]+[\s.]", r"^(chapter|section)\s+[0-9]+\b", r"^annex\s+[0-9a-z]\b",
        r"^[\w\s.\-]+\s*[-=—]\s*(accueil|beranda|breaking news|home|homepage|inicio)$",
    )
    # relevance
    flood_categories: tuple[str, ...] = ("flood", "river", "disaster")
    impact_categories: tuple[str, ...] = ("impact",)
    min_hits: int = 2
    many_lines: int = 20
    short_line_words: int = 14
    long_sentence_words: int = 30
    large_words: int = 5000
    # reports and models
    event_words: str = EVENT_WORDS
    strict_domains: tuple[str, ...] = (
        "baltimoresun.com", "cepredenac.org", "clarin.com", "elespectador.com", "eltiempo.com", "idl-reporteros.pe", "lasillavacia.com", "letrap.com.ar", "meteored.com.ar", "ojo-publico.com", "quedigital.com.ar",
        "texastribune.org", "wayka.pe", "ayka.pe",
    )
    #: (reason, what it looks at: title, head (title and start of body), pattern, whether event words save it)
    title_rules: tuple[tuple[str, str, str, bool], ...] = field(
        default=(
            ("weather_forecast_page", "title", anywhere(r"(weather\s*\|\s*forecast|traffic\s*\|\s*road) conditions"), False),
            ("journalist_profile", "title", anywhere("staff personalities"), False),
            ("journalist_profile", "url", anywhere("/staff-personalities"), False),
            ("covid_content", "title", words("contagios", "coronavirus", r"covid[-\s]?19", "cuarentena", "pandemia", "vacuna(ci[oó]n)?"), True),
            ("cemaden_institutional", "cemaden", anywhere("água mineral", "baterias", "escolas participam", "lança edital", "licitaç[aã]o", "manutenção predial", "mobiliário", "promove palestra", "recebe estagiár"), False),
            ("cemaden_forecast_bulletin", "title", anywhere("previsão de risco geo-hidrológico"), False),
            ("institutional_portal", "title", anywhere("consejo de representantes", r"^noticias\s*::", "notas de prensa covid", r"\|\s*ocha\s*$", "rumo aos [0-9]+ anos"), False),
            ("non_article_content", "title", anywhere(r"\barchives\b\s*$", r"live:\s*.+ news", r"traffic\s*\|", "watch .+ (news program|videos) online"), False),
            ("weather_forecast_es_pt", "title", words(r"clima\s+de\s+hoy", r"forecast\s+today", "pronóstico", "previsão do tempo", "previsão.*semana", r"previsiones?\s+del\s+tiempo", "tempo.*próximos"), True),
            ("climate_policy_not_event", "title", words(r"cambio\s+climático", r"climate\s+change", r"desarrollo\s+sostenible", r"emisiones?\s+de\s+co2", r"greenhouse\s+gas", r"mudança\s+climática", r"planejamento\s+urbano", r"política\s+ambiental"), True),
            ("fire_not_flood", "head", words("bushfire", r"forest\s+fire", "inc[eê]ndio", "wildfire"), True),
            ("disease_not_flood", "head", words("aftosa", "chikungunya", "cólera", "dengue", "ébola", r"fiebre\s+amarilla", r"gripe\s+aviar", "hepatitis", "influenza", "malaria", "polio", "saramp[ií]on"), True),
            ("crime_not_flood", "head", words("asesin", "balacera", "cartel", "CJNG", r"crimen\s+organizado", "droga", "ELN", "extors", "FARC", "guerrill", "homicid", "narco(vuelo)?", "secuestr", "Sinaloa"), True),
            ("mining_not_flood", "head", words(r"aluvial\s+mining", "garimpo", r"mina\s+de\s+oro", r"mine\s+(disaster|tailings)", r"miner[íi]a\s+de\s+oro", r"miner(o|ía)\s+ilegal", r"mount\s+polley", r"tailings\s+dam"), True),
            ("earthquake_not_flood", "head", words("earthquake", "seismic", "seismograph", "sismo", "temblor", "terremoto"), True),
            ("foreign_country_flood", "title", words(r"en\s+(Alemania|Bangladesh|China|Filipinas|[IÍ]ndia|Indonesia|Pakistán|Ucrania)", r"in\s+(Bangladesh|China|Germany|[IÍ]ndia|Indonesia|Pakistan|Philippines|Ukraine)", r"na\s+(Alemanha|China|[IÍ]ndia|Ucrânia)", r"no\s+Paquistão"), True),
            ("water_scarcity_not_flood", "title", words("drought", r"(escasez|falta)\s+de\s+agua", "sequ[íi]a"), True),
        )
    )
    sanitize_chars: int = 1500
    snippet_chars: int = 600
    head_chars: int = 300
    model_words: int = 300
    model_chars: int = 1000


DEFAULT = Profile()
