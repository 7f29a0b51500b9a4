"""Word lists, patterns and limits that results depend on.

Everything in this file is data, kept together and in dictionary order because
the order decides which entry wins.
"""

from __future__ import annotations

# --- fixed values: brand keys in match order -> brand label -------------------
BRANDS = (
    ("tine", "TINE"),
    ("oatly", "OATLY"),
    ("prior", "Prior"),
    ("q meieriene", "Q"),
    ("q-meieriene", "Q"),
    ("q", "Q"),
    ("melange", "Melange"),
    ("soft flora", "Soft Flora"),
    ("alpro", "Alpro"),
    ("synnøve", "Synnøve"),
    ("synnøve finden", "Synnøve Finden"),
    ("rørosmeieriet", "Rørosmeieriet"),
    ("castello", "Castello"),
    ("kavli", "Kavli"),
    ("fjordland", "Fjordland"),
    ("yoplait", "Yoplait"),
    ("danonino", "Danonino"),
    ("helios", "Helios"),
    ("stange", "Stange"),
    ("vita hjertego'", "Vita hjertego'"),
    ("sproud", "Sproud"),
    ("bremykt", "Bremykt"),
    ("mills", "Mills"),
    ("arla", "Arla"),
    ("go'", "Go'"),
    ("go'morgen", "Go'morgen"),
    ("go'dag", "Go'dag"),
    ("galbani", "Galbani"),
    ("président", "Président"),
    ("becel", "Becel"),
)

# --- fixed values: subcategory -> keywords, in match order --------------------
SUBCATEGORIES = (
    ("melk", ("melk", "lettmelk", "skummet", "mjølk", "litago", "helmelk", "kulturmjølk")),
    (
        "plantebasert",
        ("havredrikk", "soyadrikk", "mandeldrikk", "mylk", "ikaffe", "plantebasert", "plantedrikk"),
    ),
    (
        "ost",
        (
            "ost", "norvegia", "jarlsberg", "geitost", "mozzarella", "cheddar", "pizzaost",
            "manchego", "blue", "selbu blå", "parmigiano", "grana padano",
        ),
    ),
    (
        "smør",
        ("smør", "meierismør", "margarin", "melange", "soft flora", "brelett", "bremykt"),
    ),
    ("egg", ("egg", "høner")),
    (
        "fløte_rømme",
        (
            "rømme", "crème fraîche", "matfløte", "havrefløte", "imat", "matfrisk",
            "matfløyel", "fløte", "kremfløte",
        ),
    ),
    ("yoghurt", ("yoghurt", "skyr", "biola", "go'morgen", "activia", "go'dag")),
    ("kjølte_desserter", ("pudding", "risgrøt", "rispudding", "risengrynsgrøt")),
    ("cottage_cheese", ("cottage cheese", "kesam", "kvarg", "cottage")),
)
OTHER_SUBCATEGORY = "other"

# --- fixed values: cheese, egg and dietary terms ------------------------------
CHEESE_PREPARATIONS = (
    ("Skivet", ("skivet", "skiver")),
    ("Revet", ("revet", "raspet")),
    ("Hel", ("hel",)),
)
CHEESE_TYPES = ("hvit", "blå", "brie", "cheddar", "feta", "parmesan", "geitost", "brunost")
EGG_TYPES = (
    ("Frittgående", ("frittgående",)),
    ("Økologisk", ("økologisk",)),
    ("Friland", ("friland",)),
)
DIETARY_TERMS = (
    ("lactose_free", ("laktosefri", "uten laktose")),
    ("gluten_free", ("glutenfri", "uten gluten")),
    ("organic", ("økologisk", "organic", "eco", "øko")),
    ("vegan", ("vegansk", "vegan", "plantebasert")),
)

# --- fixed values: flavours and product types, in match order -----------------
FLAVOURS = (
    "jordbær", "vanilje", "sjokolade", "bringebær", "blåbær", "skogsbær", "kakao",
    "karamell", "sitron", "eple", "kanel", "kardemomme", "banan",
)
PRODUCT_TYPES = (
    ("lettmelk", ("lettmelk", "lett melk")),
    ("helmelk", ("helmelk", "hel melk")),
    ("skummet", ("skummet", "skumma")),
    ("kefir", ("kefir",)),
    ("kulturmelk", ("kulturmelk", "kulturmjølk")),
    ("ekstra lett", ("ekstra lett", "extra lett")),
)

# --- fixed values: amounts, units and their patterns --------------------------
# Digits and blanks are ASCII after clean_text; letters fold with Unicode rules.
AMOUNT = r"[0-9]+(?:[.,][0-9]+)?"
SIZE = r"([0-9]+(?:[.,][0-9]+)?)\s*(l|ml|g|kg|dl|cl|stk)"
PERCENTAGE = r"([0-9]+(?:[.,][0-9]+)?)%"
MULTIPACK = r"([0-9]+)x([0-9]+(?:[.,][0-9]+)?)\s*(g|ml|l|kg|stk)"
PACK_QUANTITY = r"([0-9]+)\s*(?:pk|stk|pakk|pakning)"
EGG_SIZE = r"(?:str\.?|størrelse)\s*(xs|s|m|l|xl)"
EGG_QUANTITY = r"([0-9]+)\s*(?:stk|egg)"
AGING = r"([0-9]+)\s*(?:mnd|måned)"
PRICE = r"([0-9]+[,.][0-9]+|[0-9]+)"
UNIT_PRICE = r"([0-9]+[,.]?[0-9]*)\s*/\s*([\p{L}\p{N}_]+)"
VOLUME_PART = r"([0-9]+[,.]?[0-9]*)\s*(ml|l|dl|cl|g|kg)"
FAT_PART = r"([0-9]+[,.]?[0-9]*)\s*%\s*fett"
KNOWN_BRAND_PARTS = ("TINE", "Q", "SYNNØVE", "ARLA", "OATLY")
BRAND_PART_LIMIT = 20
PRODUCT_ID_LENGTH = 32
RUN_HASH_LENGTH = 12
RUN_BASE_LENGTH = 8

# --- fixed values: page text and URL markers ----------------------------------
HEADER_TEXT = "Hopp til hovedinnhold"
SKIPPED_LABELS = ("Alle i Meieri, ost og egg", "Alle i Drikke")
SUBCATEGORY_LINK_WORDS = ("melk", "plantebaserte", "smør", "egg", "fløte", "yogurt", "ost")
MAIN_CATEGORY_PREFIX = "Alle i "
MORE_BUTTON_TEXT = "Vis flere"
FIRST_STORE_MARKER = "/products/"
FIRST_STORE_SECTIONS = (
    "/products/news/", "/products/discounts/", "/products/favourites/", "/products/search",
)
SECOND_STORE_MARKER = "/varer/"
SECOND_STORE_SECTIONS = ("/varer/tilbud/", "/varer/nyheter/", "/varer/oppskrifter/")
CATEGORY_MARKER = "/categories/"
UNCATEGORIZED = "uncategorized"
PAGE_CAP = 20
