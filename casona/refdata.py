"""Vocabularies, places, points of interest, limits and patterns.

Everything here is a plain constant that results depend on; no logic.
"""

# ---- fixed values: regions (slug, name, display order) ----
REGIONS = [
    ("central-pacific", "Central Pacific", 10),
    ("guanacaste", "Guanacaste", 20),
    ("central-valley", "Central Valley", 30),
    ("nicoya", "Nicoya Peninsula", 40),
    ("caribbean", "Caribbean Coast", 50),
    ("south-pacific", "South Pacific", 60),
]

# ---- fixed values: bounding boxes, first match wins
#      (region, min lat, max lat, min lng, max lng) ----
REGION_BOXES = [
    ("caribbean", 9.4, 11.0, -83.7, -82.5),
    ("south-pacific", 8.3, 9.4, -84.0, -82.7),
    ("central-pacific", 9.3, 9.85, -84.85, -84.0),
    ("guanacaste", 10.15, 11.2, -86.0, -85.0),
    ("nicoya", 9.55, 10.15, -85.85, -84.95),
    ("central-valley", 9.7, 10.3, -84.5, -83.7),
]

COUNTRY_BOX = (7.5, 12.0, -86.5, -82.0)

# ---- fixed values: gazetteer of towns by region. Substring lookup takes the first
#      key in list order, so the order of groups and of names is part of the data. ----
GAZETTEER_GROUPS = [
    ("guanacaste", [
        "tamarindo", "playa grande", "flamingo", "playa flamingo", "potrero", "conchal",
        "brasilito", "playa hermosa", "playas del coco", "coco", "ocotal", "papagayo", "liberia",
    ]),
    ("nicoya", [
        "nosara", "playa guiones", "samara", "santa teresa", "malpais", "mal pais",
        "montezuma", "playa carmen", "hermosa",
    ]),
    ("central-pacific", [
        "jaco", "playa jaco", "manuel antonio", "quepos", "herradura", "esterillos",
    ]),
    ("south-pacific", [
        "dominical", "uvita", "ojochal", "playa hermosa de osa", "puerto jimenez",
        "drake bay", "bahia ballena",
    ]),
    ("caribbean", ["puerto viejo", "cahuita", "manzanillo", "limon", "puerto limon"]),
    ("guanacaste", [
        "playa lagarto", "lagarto", "langosta", "playa langosta", "marbella", "junquillal",
        "playa junquillal", "negra", "playa negra", "santa cruz", "hacienda pinilla",
        "reserva conchal", "cabo velas",
    ]),
    ("nicoya", [
        "cobano", "tambor", "tambor beach", "cabuya", "paquera", "playa hermosa montezuma",
    ]),
    ("central-pacific", ["los suenos", "parrita", "bejuco", "playa bejuco"]),
    ("south-pacific", ["matapalo", "cabo matapalo", "playa organos", "organos"]),
    ("central-valley", [
        "curridabat", "goicoechea", "desamparados", "moravia", "guadalupe", "tibas",
        "hatillo", "san pedro", "tres rios", "san isidro", "san isidro de coronado", "pozos",
        "lindora", "ulloa", "barva", "belen", "pavas", "cariari", "rohrmoser",
    ]),
    ("central-valley", [
        "atenas", "escazu", "santa ana", "heredia", "grecia", "sarchi", "alajuela",
        "san jose", "cartago", "naranjo", "palmares", "orotina",
    ]),
]
GAZETTEER = [(name, region) for region, names in GAZETTEER_GROUPS for name in names]

# ---- fixed values: airports (code, name, type, lat, lng, region) ----
AIRPORTS = [
    ("SJO", "Juan Santamaría International Airport", "international", 9.99386, -84.20882, "central-valley"),
    ("LIR", "Daniel Oduber International Airport", "international", 10.59308, -85.54442, "guanacaste"),
    ("XQP", "Quepos La Managua Airport", "domestic", 9.44319, -84.12972, "central-pacific"),
    ("TMU", "Tambor Airport", "domestic", 9.73852, -85.01388, "nicoya"),
    ("GLF", "Golfito Airport", "domestic", 8.65370, -83.18219, "south-pacific"),
    ("NOB", "Nosara Airport", "domestic", 9.97651, -85.65300, "nicoya"),
    ("DRK", "Drake Bay Airport", "domestic", 8.71890, -83.64178, "south-pacific"),
    ("FON", "La Fortuna / Arenal Airport", "domestic", 10.47813, -84.63380, "central-valley"),
    ("TNO", "Tamarindo Airport", "domestic", 10.31350, -85.81545, "guanacaste"),
    ("PJM", "Puerto Jiménez Airport", "domestic", 8.53314, -83.30000, "south-pacific"),
]

# ---- fixed values: hospitals (name, type, lat, lng, region) ----
HOSPITALS = [
    ("Hospital CIMA San José", "private_hospital", 9.92814, -84.13222, "central-valley"),
    ("Hospital Clínica Bíblica", "private_hospital", 9.92798, -84.08200, "central-valley"),
    ("Hospital Metropolitano", "private_hospital", 9.94583, -84.12278, "central-valley"),
    ("Hospital San Rafael (Liberia)", "public_hospital", 10.63167, -85.43444, "guanacaste"),
    ("CIMA Liberia / La Pacífica", "private_hospital", 10.62500, -85.45000, "guanacaste"),
    ("Hospital Monseñor Sanabria", "public_hospital", 9.97670, -84.83330, "central-pacific"),
    ("Hospital Tony Facio", "public_hospital", 9.99000, -83.03200, "caribbean"),
    ("Hospital Escalante Pradilla", "public_hospital", 9.37500, -83.70000, "south-pacific"),
    ("Hospital Calderón Guardia", "public_hospital", 9.93414, -84.07140, "central-valley"),
    ("Hospital México", "public_hospital", 9.96770, -84.13380, "central-valley"),
    ("Hospital San Juan de Dios", "public_hospital", 9.93330, -84.08330, "central-valley"),
]

# ---- fixed values: schools (name, level, lat, lng, region) ----
SCHOOLS = [
    ("Country Day School", "international", 9.95860, -84.14930, "central-valley"),
    ("Lincoln School", "international", 9.97580, -84.10720, "central-valley"),
    ("European School", "international", 9.95620, -84.20050, "central-valley"),
    ("Costa Rica International Academy (CRIA)", "international", 10.55000, -85.69000, "guanacaste"),
    ("La Paz Community School", "international", 10.54500, -85.69900, "guanacaste"),
    ("Falcon International Academy (Manuel Antonio)", "international", 9.39000, -84.16000, "central-pacific"),
    ("Del Mar Academy (Nosara)", "international", 9.97800, -85.64900, "nicoya"),
    ("Country Day School Guanacaste", "international", 10.61580, -85.74200, "guanacaste"),
]
SCHOOL_LEVELS = ["international", "elementary", "secondary"]

# ---- fixed values: beaches (name, lat, lng, region) ----
BEACHES = [
    ("Tamarindo", 10.30000, -85.84167, "guanacaste"),
    ("Conchal", 10.41028, -85.79500, "guanacaste"),
    ("Flamingo", 10.43361, -85.78417, "guanacaste"),
    ("Potrero", 10.43889, -85.77861, "guanacaste"),
    ("Avellanas", 10.16111, -85.83833, "guanacaste"),
    ("Nosara / Guiones", 9.97500, -85.65750, "nicoya"),
    ("Sámara", 9.88556, -85.52972, "nicoya"),
    ("Santa Teresa / Mal País", 9.64778, -85.16778, "nicoya"),
    ("Montezuma", 9.65750, -85.07000, "nicoya"),
    ("Jacó", 9.61667, -84.62917, "central-pacific"),
    ("Hermosa (Central Pacific)", 9.59056, -84.61500, "central-pacific"),
    ("Manuel Antonio", 9.38972, -84.15694, "central-pacific"),
    ("Dominical", 9.25361, -83.85500, "south-pacific"),
    ("Uvita", 9.16500, -83.74250, "south-pacific"),
    ("Ojochal", 9.10472, -83.68722, "south-pacific"),
    ("Pavones", 8.39222, -83.13750, "south-pacific"),
    ("Puerto Viejo (Caribbean)", 9.65500, -82.75556, "caribbean"),
    ("Cahuita", 9.73611, -82.84778, "caribbean"),
    ("Manzanillo (Caribbean)", 9.63333, -82.65750, "caribbean"),
]

# ---- fixed values: listing categories (slug, name, display order) ----
CATEGORIES = [
    ("homes-and-villas", "Homes and Villas", 10),
    ("condominiums", "Condominiums", 20),
    ("lots", "Lots", 30),
    ("beach-properties", "Beach Properties", 40),
    ("luxury-properties", "Luxury Properties", 50),
]

# ---- fixed values: enumerations ----
PROPERTY_TYPES = ["house", "condo", "lot", "farm", "commercial", "hotel", "other"]
CURRENCIES = ["USD", "CRC"]
LANGUAGES = ["en", "es", "mixed", "unknown"]
LISTING_STATUSES = ["draft", "active", "pending_review", "sold", "withdrawn", "stale"]
RUN_STATUSES = ["running", "succeeded", "failed", "partial", "paused"]
STAGE_STATUSES = ["pending", "running", "done", "failed", "skipped"]
STAGE_COLUMNS = ["extract_status", "normalize_status", "dedupe_status", "enrich_status", "publish_status"]
TRACE_STAGES = ["enumerate", "fetch", "extract", "normalize", "dedupe", "enrich", "publish", "sync"]

# ---- fixed values: feature vocabulary ----
FEATURE_VOCAB = [
    "pool", "private_pool", "communal_pool", "infinity_pool", "jacuzzi",
    "ocean_view", "mountain_view", "jungle_view", "city_view", "valley_view", "river_view",
    "beachfront", "oceanfront", "walk_to_beach", "beach_access",
    "gated_community", "titled", "concession", "maritime_zone",
    "turnkey", "fixer", "new_construction", "pre_construction", "under_construction",
    "income_producing", "rental_potential", "investment_grade",
    "furnished", "partially_furnished", "unfurnished",
    "air_conditioning", "central_ac", "split_ac", "ceiling_fans",
    "solar", "backup_generator", "electric_vehicle_charging",
    "hoa", "private_well", "city_water", "spring_water",
    "fiber_internet", "cable_internet", "satellite_internet",
    "paved_road", "gravel_road", "4x4_required",
    "retiree_friendly", "family_friendly", "remote_work_ready",
    "horse_friendly", "agricultural", "farm", "cattle",
    "eco", "sustainable", "off_grid",
    "walkable", "walk_to_amenities",
    "guest_house", "mother_in_law_suite", "home_office",
    "security_system", "gated_entrance", "24h_security",
    "covered_parking", "garage", "multiple_parking",
    "fenced", "landscaped",
    "commercial_use_allowed", "short_term_rental_eligible",
]

# ---- fixed values: tag vocabulary ----
TAG_VOCAB = [
    "luxury", "budget", "investment", "lifestyle", "fixer_upper",
    "turnkey", "income_property", "developer_inventory", "pre_construction",
    "eco", "sustainable", "off_grid",
    "beachfront", "oceanview", "mountainview", "jungleview",
    "gated", "family", "retiree", "digital_nomad",
]

# ---- fixed values: display names of property types on the published site ----
TYPE_DISPLAY = {
    "house": "House", "condo": "Condo", "lot": "Lot / Land", "farm": "Farm",
    "commercial": "Commercial", "hotel": "Hotel", "other": "Other",
}

# ---- fixed values: HTML entities, decoded in this order ----
ENTITIES = [
    ("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"),
    ("&#8211;", "–"), ("&#8212;", "—"), ("&#8216;", "‘"), ("&#8217;", "’"),
    ("&#8220;", '"'), ("&#8221;", '"'), ("&hellip;", "…"), ("&#8230;", "…"),
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"),
]

# ---- fixed values: title noise, applied in this order. A site's own brand name is
#      added by the caller (clean_title(own_brands=...)) after the portals. ----
TITLE_PREFIX_NOISE = (
    r"(?i)^(Houses?|Condos?|Apartments?|Lots?|Properties|Real Estate|Homes?|Land)\b[^|]*\| For Sale \| "
)
TITLE_PORTAL_NAMES = [
    "RPM Real Estate", "Coldwell Banker", "Sotheby'?s", r"Realtor\.com", r"MLS\.cr",
    "Encuentra24", "Point2",
]
TITLE_COUNTRY_TAILS = [
    r"(?i) \| Costa Rica$",
    r"(?i) - Costa Rica$",
    r"(?i) · Costa Rica$",
    r"(?i) in Costa Rica$",
    r"(?i), ?Costa Rica$",
    r"(?i) - [A-Z][a-zA-Z ]+, Costa Rica$",
]
TITLE_SEARCH_ELLIPSIS = r"(?i)Search.*\.\.\. ?"
TITLE_PRICE_TAILS = [
    r" - \$[\d,]+(?:\.\d+)?(?:\s*-.*)?$",
    r"(?i) - USD ?[\d,]+(?:\.\d+)?(?:\s*-.*)?$",
    r"(?i) - CRC ?[\d,]+(?:\.\d+)?(?:\s*-.*)?$",
    r" : \d+$",
    r"(?i)^For Sale - ",
]

# ---- fixed values: resize parameters ignored when two photo URLs are compared ----
RESIZE_PARAMS = [
    "w", "h", "width", "height", "q", "quality", "fit", "crop", "rs", "rt",
    "format", "fm", "auto", "dpr", "s", "size", "sz", "version", "v", "cb",
]

# ---- fixed values: photo rejection rules, first match wins (subject, pattern, reason).
#      Subject "url" is the lower-cased URL, "file" its last path segment. ----
PHOTO_RULES = [
    ("url", r"\b(footer|logo|sprite|icon|badge|banner|placeholder|watermark|favicon|avatar|verified|verified[%_]?badge)\b", "logo_or_branding"),
    ("url", r"badgehuawei|appgal|appgallery|app[-_]?gallery|google[-_]?play|app[-_]?store|huawei[-_]?gallery", "app_store_badge"),
    ("url", r"casas24|carros24|encuentra24[-_]?badge|e24[-_]?badge|arrios", "site_branding"),
    ("file", r"^mls[-_.][\w.-]*\.(png|jpe?g|webp|svg)$", "site_branding"),
    ("url", r"mls\.cr[-_.][\w.-]*\.(png|jpe?g|webp|svg)", "site_branding"),
    ("url", r"coldwell[-_]banker[-_]logo|\bcb[-_](logo|brand)|coldwell.*logo", "site_branding"),
    ("url", r"wp-content/uploads/\d{4}/\d{2}/(logo|banner|hero|brand)", "site_branding"),
    ("url", r"\.(svg|gif)(\?|$)", "icon"),
]
PHOTO_MIN_WIDTH, PHOTO_MIN_HEIGHT = 300, 200
PHOTO_MIN_ASPECT, PHOTO_MAX_ASPECT = 0.4, 4.0

# ---- fixed values: breadcrumb levels that are navigation, not places ----
BREADCRUMB_SKIP = r"(?i)^(home|costa rica|real estate|for sale|properties|listings|search|sale)$"
NAV_NOISE_CLASSIFIEDS = (
    r"(?i)^(home|real estate|properties|listings|search|sale|rent|costa rica|jobs|services|cars|vehicles"
    r"|jobs & services|for sale|community|all)$"
)
NAV_NOISE_GENERIC = (
    r"(?i)^(home|real estate|properties|listings|search|sale|rent|costa rica|for sale|sales|all)$"
)
NAV_NOISE_RENDERED = (
    r"(?i)^(home|real estate|properties|listings|search|sale|rent|costa rica|for sale|sales|all|cri)$"
)

# ---- fixed values: exchange rates (units per USD) used when no rate table is given ----
FALLBACK_RATES = {"CRC": 540.0, "USD": 1.0}

# ---- fixed values: limits ----
PAUSE_ERROR_RATE = 0.20
PAUSE_5XX_RATE = 0.10
PAUSE_MIN_SAMPLE = 30
SYNC_BATCH_SIZE = 25
PROMPT_HTML_CHARS = 60_000
EMBEDDING_DIM = 1024
TOP_K = 3
MERGE_THRESHOLD = 0.85
REVIEW_THRESHOLD = 0.60
SEARCH_PAGE_SIZE = 24
MAX_POI_KM = 200.0
SQM_PER_SQFT = "0.092903"
SQM_PER_ACRE = "4046.86"

# ---- fixed values: model prices in USD per million tokens (family, input, output) ----
MODEL_PRICES = [("haiku", 1.0, 5.0), ("sonnet", 3.0, 15.0)]

# ---- fixed values: sources (slug, name, base URL) ----
SOURCES = [
    ("encuentra24", "Encuentra24 Costa Rica", "https://www.encuentra24.com/costa-rica-en/real-estate-for-sale"),
    ("point2homes-cr", "Point2 Homes Costa Rica", "https://www.point2homes.com/CR/Real-Estate-Listings.html"),
    ("mlscr", "MLS Costa Rica", "https://www.mls.cr"),
    ("coldwell-banker-cr", "Coldwell Banker Costa Rica", "https://www.coldwellbankercostarica.com"),
    ("developers-generic", "Partner Developers", "https://developers.example"),
    ("realtor-com-cr", "Realtor.com International — Costa Rica", "https://www.realtor.com/international/cr/"),
    ("re-cr", "RE/MAX Costa Rica", "https://www.re.cr/en/costa-rica-real-estate"),
    ("coldwell-cb-tamarindo", "Coldwell Banker Tamarindo", "https://www.coldwellbankertamarindo.com/property-for-sale"),
    ("properties-in-cr", "Properties in Costa Rica", "https://www.propertiesincostarica.com/"),
    ("sothebys-cr", "Sothebys International Realty Costa Rica", "https://www.sothebysrealty.com/eng/sales/cri"),
    ("dominical-realty", "Dominical Realty", "https://www.dominicalrealty.com/"),
    ("two-cr-real-estate", "2 Costa Rica Real Estate", "https://www.2costaricarealestate.com/"),
    ("cr-dream-makers", "Costa Rica Dream Makers", "https://www.costaricadreammakers.com/en/real-estate-listings.php"),
    ("rpm-real-estate-cr", "RPM Real Estate Costa Rica", "https://rpmrealestatecr.com/"),
]

# ---- fixed values: data-grid field groups ----
FIELD_GROUPS = {
    "Identity": ["slug", "status", "property_type", "listing_type", "mls_id", "mls_status"],
    "Title / Copy": ["title_en", "title_es", "description_en", "notes"],
    "Pricing": [
        "price", "price_currency", "price_usd", "price_per_sqm", "list_price_original_usd",
        "previous_list_price_usd", "sold_price_usd", "hoa_fee_usd", "hoa_fee_frequency",
        "taxes_usd_annual", "tax_year", "estimated_closing_usd", "rental_income_potential", "luxury_tax_yn"],
    "Dimensions": [
        "bedrooms", "bathrooms", "bathrooms_full", "bathrooms_half", "bathrooms_total", "interior_sqm",
        "lot_sqm", "year_built", "year_renovated", "stories_total", "floor_number",
        "total_floors_in_bldg", "parking_spaces", "garage_spaces"],
    "Construction & condition": ["construction_status", "condition", "architectural_style"],
    "Location": [
        "region_slug", "province", "canton", "district", "locality", "address_line", "postal_code",
        "country", "community_name", "building_name", "gated_community", "lat", "lng", "geocode_confidence"],
    "Distances": [
        "distance_to_beach_km", "distance_to_airport_km", "nearest_airport_code", "distance_to_hospital_km",
        "nearest_hospital_name", "distance_to_school_km", "nearest_school_name", "distance_to_grocery_km",
        "school_district", "elementary_school", "secondary_school"],
    "View / pool / waterfront": [
        "view_types", "pool_features", "waterfront_yn", "waterfront_features", "beachfront_yn"],
    "Amenities": [
        "features", "interior_features", "exterior_features", "parking_features", "appliances", "flooring",
        "cooling", "heating", "furnishings_included", "hoa_amenities", "hoa_name"],
    "Costa Rica legal/utilities": [
        "title_status", "maritime_zone", "foreigner_buyable", "road_access", "water_source", "electricity",
        "internet_quality", "zoning"],
    "Tags": ["tags_ai", "tags_human"],
    "Lifecycle": [
        "listed_at", "last_seen_at", "days_on_market", "under_contract", "sold_at", "confidence",
        "realtor_review_status", "internal_quality_score"],
    "Agent / brokerage": [
        "listing_agent_name", "listing_agent_phone", "listing_agent_email", "source_brokerage",
        "source_brokerage_phone", "agent_id"],
    "Source / WP": [
        "primary_source_url", "wp_post_id", "wp_synced_at", "photo_count", "virtual_tour_url", "video_url",
        "floorplan_url"],
    "Catch-all": ["extra_data", "realtor_review_notes"],
}
