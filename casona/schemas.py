"""Declared schemas: extracted record, raw payload, canonical listing and photos."""

from __future__ import annotations


# Extracted record: field -> kind. Kinds: string, number, int, boolean, strings (array of text).
EXTRACTED_FIELDS = {
    "title": "string", "description": "string", "language": "string", "property_type": "string",
    "price": "number", "price_currency": "string", "list_price_original": "number", "hoa_fee": "number",
    "hoa_fee_frequency": "string", "hoa_amenities": "strings", "hoa_name": "string", "taxes_annual": "number",
    "tax_year": "int",
    "bedrooms": "number", "bathrooms": "number", "bathrooms_full": "number", "bathrooms_half": "number",
    "interior_sqm": "number", "lot_sqm": "number", "year_built": "int", "year_renovated": "int",
    "stories_total": "number", "floor_number": "int", "total_floors_in_bldg": "int",
    "construction_status": "string", "condition": "string", "architectural_style": "string",
    "parking_spaces": "int", "garage_spaces": "int", "parking_features": "strings",
    "pool_features": "strings", "view_types": "strings", "waterfront_yn": "boolean",
    "waterfront_features": "strings", "beachfront_yn": "boolean",
    "province": "string", "canton": "string", "district": "string", "locality": "string",
    "address_line": "string", "postal_code": "string", "community_name": "string", "building_name": "string",
    "gated_community": "boolean", "lat": "number", "lng": "number",
    "features": "strings", "interior_features": "strings", "exterior_features": "strings",
    "appliances": "strings", "flooring": "strings", "cooling": "strings", "heating": "strings",
    "furnishings_included": "string",
    "title_status": "string", "maritime_zone": "boolean", "foreigner_buyable": "boolean",
    "road_access": "string", "water_source": "string", "electricity": "string", "internet_quality": "string",
    "zoning": "string", "rental_income_potential": "string",
    "listed_at": "string", "mls_id": "string", "mls_status": "string", "under_contract": "boolean",
    "listing_agent_name": "string", "listing_agent_phone": "string", "listing_agent_email": "string",
    "source_brokerage": "string", "source_brokerage_phone": "string",
    "virtual_tour_url": "string", "video_url": "string", "floorplan_url": "string",
    "bedroom_features": "strings", "dining_room_features": "strings", "family_room_features": "strings",
    "kitchen_features": "strings", "laundry_features": "strings", "fireplaces_count": "int",
    "fireplace_features": "strings", "property_subtype": "string", "foundation": "strings", "roof": "strings",
    "new_construction_yn": "boolean", "total_structure_area_sqm": "number",
    "pool_yn": "boolean", "jacuzzi_yn": "boolean", "parking_yn": "boolean", "telephone_yn": "boolean",
    "internet_types": "strings", "television_types": "strings", "ac_types": "strings",
    "notes": "string",
}

NUMBER_TYPES = {
    "price": "decimal(14,2)", "list_price_original": "decimal(14,2)", "hoa_fee": "decimal(14,2)",
    "taxes_annual": "decimal(14,2)", "bedrooms": "decimal(4,1)", "bathrooms": "decimal(4,1)",
    "bathrooms_full": "decimal(4,1)", "bathrooms_half": "decimal(4,1)", "interior_sqm": "decimal(10,2)",
    "lot_sqm": "decimal(12,2)", "stories_total": "decimal(3,1)", "lat": "decimal(9,6)", "lng": "decimal(9,6)",
    "total_structure_area_sqm": "decimal(12,2)",
}


def spark_type(field: str) -> str:
    kind = EXTRACTED_FIELDS[field]
    return {
        "string": "string", "boolean": "boolean", "int": "int", "strings": "array<string>",
        "number": NUMBER_TYPES.get(field, "double"),
    }[kind]


# Merge mode of every published column: ``fill`` keeps an existing value, ``replace`` takes a new
# non-empty one, ``keep`` never changes on merge.
MERGE_MODES = {
    **dict.fromkeys(["slug", "property_type"], "keep"),
    **dict.fromkeys(
        ["title_en", "title_es", "description_en", "description_es", "description_raw", "price", "price_currency",
         "price_usd", "price_per_sqm", "hoa_fee_usd", "hoa_amenities", "bathrooms", "bedrooms", "interior_sqm",
         "lot_sqm", "parking_features", "pool_features", "view_types", "waterfront_features", "features",
         "interior_features", "exterior_features", "appliances", "flooring", "cooling", "heating", "tags_ai",
         "region_slug", "country", "distance_to_beach_km", "distance_to_airport_km", "nearest_airport_code",
         "distance_to_hospital_km", "nearest_hospital_name", "distance_to_school_km", "nearest_school_name",
         "floorplans", "extra_data", "internet_types", "television_types", "ac_types", "categories",
         "bedroom_features", "dining_room_features", "family_room_features", "kitchen_features",
         "laundry_features", "fireplace_features", "foundation", "roof"], "replace"),
    **dict.fromkeys(
        ["list_price_original_usd", "hoa_fee_frequency", "hoa_name", "taxes_usd_annual", "tax_year",
         "rental_income_potential", "bathrooms_full", "bathrooms_half", "year_built", "year_renovated",
         "stories_total", "floor_number", "total_floors_in_bldg", "construction_status", "condition",
         "architectural_style", "parking_spaces", "garage_spaces", "waterfront_yn", "beachfront_yn",
         "furnishings_included", "title_status", "maritime_zone", "foreigner_buyable", "road_access",
         "water_source", "electricity", "internet_quality", "zoning", "province", "canton", "district", "locality",
         "address_line", "postal_code", "community_name", "building_name", "gated_community", "lat", "lng",
         "geocode_confidence", "listed_at", "mls_id", "mls_status", "listing_agent_name", "listing_agent_phone",
         "listing_agent_email", "source_brokerage", "source_brokerage_phone", "primary_source_url",
         "virtual_tour_url", "video_url", "floorplan_url", "notes", "pool_yn", "jacuzzi_yn", "parking_yn",
         "telephone_yn", "fireplaces_count", "property_subtype", "new_construction_yn",
         "total_structure_area_sqm"], "fill"),
}

RAW_PAGE = "source string, url string, html string, fetched_at timestamp"

# Columns of the canonical table beyond the extracted record, with their types.
CANONICAL_EXTRA = {
    "id": "string", "slug": "string", "status": "string", "listing_type": "string", "title_en": "string",
    "title_es": "string", "description_en": "string", "description_es": "string", "description_raw": "string",
    "price_usd": "decimal(14,2)", "price_per_sqm": "decimal(12,2)", "list_price_original_usd": "decimal(14,2)",
    "previous_list_price_usd": "decimal(14,2)", "price_history": "string", "sold_price_usd": "decimal(14,2)",
    "luxury_tax_yn": "boolean", "estimated_closing_usd": "decimal(10,2)", "hoa_fee_usd": "decimal(10,2)",
    "taxes_usd_annual": "decimal(10,2)", "bathrooms_total": "decimal(4,1)", "region_slug": "string",
    "country": "string", "geocode_confidence": "string", "distance_to_beach_km": "decimal(6,1)",
    "distance_to_airport_km": "decimal(6,1)", "nearest_airport_code": "string",
    "distance_to_hospital_km": "decimal(6,1)", "nearest_hospital_name": "string",
    "distance_to_school_km": "decimal(6,1)", "nearest_school_name": "string",
    "distance_to_grocery_km": "decimal(6,1)", "school_district": "string", "elementary_school": "string",
    "secondary_school": "string", "tags_ai": "array<string>", "tags_human": "array<string>",
    "categories": "array<string>", "property_labels": "array<string>", "agent_id": "string",
    "last_seen_at": "timestamp", "days_on_market": "int", "sold_at": "date", "confidence": "decimal(3,2)",
    "primary_source_url": "string", "all_source_urls": "string", "photo_count": "int",
    "floorplans": "string", "extra_data": "string", "wp_post_id": "int", "wp_synced_at": "timestamp",
    "wp_content_hash": "string", "tour_360_url": "string", "video_thumbnail_url": "string",
    "energy_class": "string", "energy_index": "string", "show_map": "boolean", "show_street_view": "boolean",
    "attachments": "string", "realtor_review_status": "string", "realtor_review_notes": "string",
    "internal_quality_score": "decimal(3,2)", "created_at": "timestamp", "updated_at": "timestamp",
}
NOT_CANONICAL = {"title", "description", "language", "list_price_original", "hoa_fee", "taxes_annual"}
CANONICAL = {
    **{f: spark_type(f) for f in EXTRACTED_FIELDS if f not in NOT_CANONICAL}, **CANONICAL_EXTRA, "listed_at": "date",
}

# Columns people may edit by hand: everything but identity, bookkeeping and sync state.
NOT_EDITABLE = {
    "id", "slug", "previous_list_price_usd", "price_history", "price_per_sqm", "bathrooms_total", "country",
    "last_seen_at", "confidence", "all_source_urls", "photo_count", "floorplans", "extra_data", "wp_post_id",
    "wp_synced_at", "wp_content_hash", "created_at", "updated_at",
}
EDITABLE = sorted(set(CANONICAL) - NOT_EDITABLE)
