"""Word lists, tables and constants the results depend on.

Every list here is data that must hold exactly these entries for the results
to be right. No logic lives in this module.
"""

# --- Fixed values: host suffixes that are never company sites ---------------
BLOCKED_SUFFIXES = """
facebook.com instagram.com twitter.com x.com tiktok.com pinterest.com reddit.com threads.net snapchat.com
youtube.com vimeo.com
quora.com stackexchange.com stackoverflow.com
google.com bing.com yahoo.com aol.com msn.com
walmart.com amazon.com target.com costco.com ebay.com etsy.com alibaba.com aliexpress.com
wynnlasvegas.com mgmresorts.com caesars.com
instacart.com grubhub.com doordash.com ubereats.com postmates.com gopuff.com shipt.com
linkedin.com
federalregister.gov ftc.gov dshs.texas.gov agr.wa.gov agri.nv.gov gov
trademo.com zauba.com importkey.com seair.co.in
univarsolutions.com
globalcompliancenews.com compliancegate.com pharmacompass.com
morganandwestfield.com ampersandcapital.com
eurofinsus.com
redstickspice.com olivenation.com wholesalesuppliesplus.com
drug-dev.com chemxpert.com
indeed.com glassdoor.com glassdoor.co.in ziprecruiter.com monster.com careerbuilder.com
latimes.com nytimes.com washingtonpost.com wsj.com cnn.com foxnews.com bbc.com reuters.com apnews.com
usatoday.com forbes.com bloomberg.com businessinsider.com cnbc.com finance.yahoo.com
dailyhive.com coppercourier.com
prnewswire.com globenewswire.com businesswire.com prweb.com
supplychaindive.com fooddive.com bevnet.com massmarketretailers.com talkbusiness.net trellis.net
packagingdigest.com foodprocessing.com nutraceuticalsworld.com nutraceuticalbusinessreview.com
contractpharma.com candlefind.com
thomasnet.com dnb.com zoominfo.com manta.com bbb.org yellowpages.com superpages.com hotfrog.com eximpedia.app
accio.com tradekey.com kompass.com europages.com globalspec.com exportgenius.in panjiva.com volza.com
madeinwashington.com
8thandwalton.com carbon6.io vendormint.com newnexusgroup.com ozarkconsulting.com coldstreamlogistics.com
rjwgroup.com 5gsales.com supplypike.com harvestgroup.com winningwithwalmart.com getproductiv.com orderful.com
triumph.io warehousequote.com mybluegrace.com capstonelogistics.com classicharvest.com buildbunker.com
wikipedia.org wikihow.com britannica.com
fda.gov nih.gov usda.gov sec.gov census.gov
edu
arkansasedc.com
medium.com substack.com wordpress.com blogspot.com wixsite.com squarespace.com hubspot.com mailchimp.com
corporate.walmart.com marketplace.walmart.com public.walmart.com marketplacelearn.walmart.com
supplierone.helpdocs.io
mycustommanufacturer.com
yelp.com trustpilot.com sitejabber.com g2.com
""".split()

# --- Fixed values: country endings outside the target market ----------------
BLOCKED_COUNTRY_ENDINGS = (
    "ca co.uk co.in com.au com.br com.mx com.ec com.pg de fr es it jp cn in ae co.jp eu".split()
)

# --- Fixed values: endings dropped when a host becomes a company name -------
NAME_ENDINGS = "com net org io co us biz info app ai xyz tech solutions global inc".split()

# --- Fixed values: legal and descriptive words dropped from company names ---
LEGAL_WORDS = ["inc", "llc", "ltd", "corp", "company", "co"]
DESCRIPTOR_WORDS = ["international", "group", "holdings", "enterprises"]

# --- Fixed values: title beginnings that mark an article, not a company -----
ARTICLE_BEGINNINGS = [
    "how", "what", "why", "when", "where", "which", "who",
    "top", "best", "the", "a ", "an ",
    "should", "can", "is ", "are ", "do ", "does ",
    "avoid", "prevent", "guide", "review", "list",
    "walmart", "amazon",
    "private label", "contract", "custom", "manufacturing",
    "supplement", "us based", "usa based", "companies directory",
    "turnkey", "dietary supplement",
]
SERVICE_WORDS = ["manufacturing", "services", "solutions", "private label"]
TITLE_MAX_CHARS = 60
SERVICE_TITLE_MAX_CHARS = 30

# --- Fixed values: US states (name, code), alphabetical by name -------------
US_STATES = [
    ("alabama", "AL"), ("alaska", "AK"), ("arizona", "AZ"), ("arkansas", "AR"), ("california", "CA"),
    ("colorado", "CO"), ("connecticut", "CT"), ("delaware", "DE"), ("florida", "FL"), ("georgia", "GA"),
    ("hawaii", "HI"), ("idaho", "ID"), ("illinois", "IL"), ("indiana", "IN"), ("iowa", "IA"),
    ("kansas", "KS"), ("kentucky", "KY"), ("louisiana", "LA"), ("maine", "ME"), ("maryland", "MD"),
    ("massachusetts", "MA"), ("michigan", "MI"), ("minnesota", "MN"), ("mississippi", "MS"),
    ("missouri", "MO"), ("montana", "MT"), ("nebraska", "NE"), ("nevada", "NV"), ("new hampshire", "NH"),
    ("new jersey", "NJ"), ("new mexico", "NM"), ("new york", "NY"), ("north carolina", "NC"),
    ("north dakota", "ND"), ("ohio", "OH"), ("oklahoma", "OK"), ("oregon", "OR"), ("pennsylvania", "PA"),
    ("rhode island", "RI"), ("south carolina", "SC"), ("south dakota", "SD"), ("tennessee", "TN"),
    ("texas", "TX"), ("utah", "UT"), ("vermont", "VT"), ("virginia", "VA"), ("washington", "WA"),
    ("west virginia", "WV"), ("wisconsin", "WI"), ("wyoming", "WY"),
]

# --- Fixed values: compliance signals, in output order ----------------------
SIGNALS = ["sqep_mentioned", "otif_mentioned", "walmart_supplier", "compliance_pain"]
PAIN_WORDS = ["chargeback", "fine", "penalty", "deduction"]

# --- Fixed values: contact title words --------------------------------------
FIRST_CHOICE_TITLES = ["logistics", "supply chain", "transportation", "shipping", "distribution", "freight"]
SECOND_CHOICE_TITLES = ["operations", "coo", "vp operations", "general manager", "plant manager"]
LOGISTICS_TITLES = [
    "logistics", "supply chain", "transportation", "shipping", "distribution", "freight", "warehouse",
    "procurement", "fulfillment", "operations", "coo", "plant manager", "general manager",
]
CONTACT_SOURCE_RANK = {"apollo": 2, "hunter": 1}
PATTERN_NOTE = "Hunter email pattern"

# --- Fixed values: name match threshold (rounded percent) -------------------
NAME_MATCH_PERCENT = 85

# --- Fixed values: stage order ----------------------------------------------
STAGE_NUMBERS = {"web_search": "01", "sqep": "02", "import_search": "03", "apollo": "04", "dedup": "05", "hunter": "06"}
CHANNEL_ORDER = ["web_search", "sqep", "import_search", "apollo"]

# --- Fixed values: report columns -------------------------------------------
SHEET_COLUMNS = [
    "company_name", "city", "state", "phone", "website", "vertical",
    "source_channel", "estimated_employees", "estimated_revenue",
    "contact_name", "contact_title", "contact_email", "email_verified",
    "score", "tier", "status", "first_seen", "last_seen", "notes",
]
TOP_NEW_COLUMNS = ["company_name", "state", "vertical", "score", "tier", "contact_email"]
SEARCH_COLUMNS = ["company_name", "city", "state", "vertical", "product_keywords", "notes"]
