"""Table schemas, keys and vocabularies. All names and values here are fixed values of the data model."""

from __future__ import annotations

VOCABULARY = {
    "building_type": ["chung_cu", "mixed_use", "condotel", "officetel", "serviced_apartment"],
    "segment": ["binh_dan", "trung_cap", "cao_cap", "hang_sang", "sieu_sang"],
    "status": ["quy_hoach", "dang_xay", "da_ban_giao", "dang_van_hanh"],
    "handover_standard": ["shell_core", "hoan_thien_co_ban", "noi_that_lien_tuong", "full_furnished"],
    "layout_class": ["studio", "1pn", "1pn_plus", "2pn", "2pn_plus", "3pn", "4pn_plus", "duplex", "penthouse", "sky_villa", "shophouse", "officetel"],
    "massing_form": ["thap_don", "thap_doi", "tower_on_podium", "chu_u", "chu_l", "hop_khoi", "bac_thang"],
    "facade_system": ["curtain_wall", "nhom_kinh_he", "tuong_xay_op", "hon_hop"],
    "balcony_type": ["logia", "ban_cong_nho", "lech_tang", "khong_co"],
    "green_cert": ["LEED", "EDGE", "Green Mark", "LOTUS", "BREEAM", "WELL", "CASBEE", "G-SEED"],
    "area_basis": ["tim_tuong", "thong_thuy", "khong_ro"],
    "room_type": ["phong_khach", "phong_an", "bep", "phong_ngu_master", "phong_ngu_2", "phong_ngu_3", "phong_ngu_4", "wc_master", "wc_chung", "wc_khach", "phong_da_nang", "phong_lam_viec", "phong_giat", "ban_cong", "logia", "sanh_can_ho", "hanh_lang_trong_can", "kho"],
    "room_source": ["floorplan_image", "brochure_text", "listing_table", "manual"],
    "floor_label": ["dien_hinh", "podium", "tang_dich_vu", "penthouse", "tang_ham"],
    "corridor_type": ["hanh_lang_giua", "hanh_lang_ben", "core_trung_tam", "2_can_1_thang"],
    "item_category": ["san", "tuong_tran", "cua", "bep", "thiet_bi_ve_sinh", "dieu_hoa_thong_gio", "thiet_bi_dien", "smart_home", "ban_cong", "thang_may", "an_ninh_pccc"],
    "amenity_category": ["be_boi", "the_thao_gym", "tre_em", "suc_khoe_spa", "cong_dong_su_kien", "thuong_mai_fnb", "canh_quan_vuon", "dich_vu_le_tan", "do_xe", "thu_cung", "khong_gian_lam_viec", "van_hoa_nghe_thuat"],
    "amenity_location": ["tang_ham", "khoi_de", "podium", "tang_trung", "rooftop", "ngoai_troi"],
    "market": ["so_cap", "thu_cap", "cho_thue"],
    "currency": ["VND", "USD", "KRW", "CNY", "SGD", "EUR", "JPY", "TWD", "HKD", "THB"],
    "price_unit": ["per_m2", "per_unit", "per_m2_month"],
    "price_source": ["cdt_official", "san_moi_gioi", "portal_niem_yet", "giao_dich_thuc", "bao_cao_cbre_jll", "bao_chi"],
    "confidence": ["high", "medium", "low"],
}
#: Pages by what they were fetched for; those of the official group are trusted.
PURPOSES = ["official_overview", "floorplan", "brochure_pdf", "amenities", "handover_spec", "product_mix", "price_primary", "price_secondary", "architecture", "news_report", "market_report"]
OFFICIAL = ["official_overview", "brochure_pdf", "handover_spec", "floorplan", "product_mix", "amenities"]
DOUBTFUL = ["price_secondary", "news_report"]

#: US dollars for one unit of currency.
FX_TO_USD = {"USD": 1.0, "VND": 1 / 26_100, "KRW": 1 / 1_390, "CNY": 1 / 7.15, "JPY": 1 / 155.0, "SGD": 1 / 1.30, "EUR": 1.08, "TWD": 1 / 32.5, "HKD": 1 / 7.8, "THB": 1 / 34.5}

#: Columns of each table in order; an enum column names its vocabulary after a colon.
TABLES = {
    "building": "building_id string, building_name string, building_name_local string, project_name string, tower_codes array<string>, linked_case_id string, is_target boolean, country string, city string, district string, address string, latitude double, longitude double, developer string, official_website string, brochure_url string, building_type string, segment string, status string, year_launch int, year_handover int, num_towers int, num_floors_above int, num_basements int, height_m double, num_units_total int, land_area_m2 double, gfa_m2 double, nfa_sale_m2 double, efficiency_ratio_pct double, building_density_pct double, green_area_pct double, parking_ratio double, unit_types_summary array<string>, unit_area_min_m2 double, unit_area_max_m2 double, units_per_floor_typical int, dominant_layout_class string, mix_by_bedroom_pct map<string,double>, handover_standard string, handover_brands array<string>, amenity_count bigint, amenity_highlights array<string>, architect_firm string, architect_country string, interior_designer string, landscape_architect string, architectural_style array<string>, design_concept string, design_concept_keywords array<string>, massing_form string, facade_material array<string>, facade_system string, window_wall_ratio_pct double, balcony_type string, floor_to_ceiling_m double, signature_features array<string>, green_cert string, green_cert_level string, awards array<string>, orientation_note string",
    "unit_type": "unit_type_id string, building_id string, type_code string, type_name string, layout_class string, bedrooms int, bathrooms double, has_multipurpose_room boolean, area_gross_m2 double, area_net_m2 double, area_basis_reported string, ratio_net_gross_pct double, area_balcony_m2 double, num_units_of_type int, share_of_total_pct double, facing array<string>, view_type array<string>, is_corner boolean, floorplan_url string, floorplan_file string",
    "unit_room": "room_id string, unit_type_id string, room_code string, room_type string, room_label_raw string, area_m2 double, width_m double, length_m double, has_window boolean, is_ensuite boolean, position_note string, source_type string",
    "floor_plate": "floor_plate_id string, building_id string, tower_code string, floor_range string, floor_label string, units_per_floor int, unit_type_mix map<string,double>, gfa_per_floor_m2 double, nfa_per_floor_m2 double, efficiency_per_floor_pct double, corridor_type string, num_elevators int, num_elevators_service int, units_per_elevator double, num_stairs int, core_position string, floorplate_url string",
    "handover_item": "handover_id string, building_id string, applies_to_unit_type_id string, item_code string, item_category string, item_name string, item_spec string, brand string, brand_origin string, is_included boolean, note string",
    "amenity": "amenity_id string, building_id string, amenity_category string, amenity_name string, amenity_name_local string, location string, floor_level string, area_m2 double, is_indoor boolean, is_resident_free boolean, operator_brand string, is_highlight boolean",
    "price_obs": "price_id string, building_id string, unit_type_id string, market string, price_min double, price_max double, price_avg double, currency string, price_unit string, price_basis string, includes_vat boolean, includes_maintenance_fee boolean, period string, observed_at string, sample_size int, source_type string, fx_rate_to_usd double, price_usd_per_m2 double, listing_url string",
}
#: Table names in order of the stacked output, each with its key and short label.
STACK = {"building": ("building_id", "B1"), "unit_type": ("unit_type_id", "B2"), "unit_room": ("room_id", "B3"), "floor_plate": ("floor_plate_id", "B4"), "handover_item": ("handover_id", "B5"), "amenity": ("amenity_id", "B6"), "price_obs": ("price_id", "B7")}
ENUMS = {
    "building_type": "building_type", "segment": "segment", "status": "status", "handover_standard": "handover_standard", "massing_form": "massing_form", "facade_system": "facade_system",
    "balcony_type": "balcony_type", "green_cert": "green_cert", "layout_class": "layout_class", "area_basis_reported": "area_basis", "room_type": "room_type", "floor_label": "floor_label",
    "corridor_type": "corridor_type", "item_category": "item_category", "amenity_category": "amenity_category", "location": "amenity_location", "market": "market", "currency": "currency",
    "price_unit": "price_unit", "price_basis": "area_basis",
}
PAGES = "building_id string, page_idx int, name string, url string, purpose string, title string, html string, text string"
MANIFEST = "building_id string, accessed_at string, total int, ok int, floorplan_images int, sources array<struct<idx:int,title:string,purpose:string,expected_content:string,url:string,slug:string,accessed_at:string,kind:string,http_status:int,chars:int,page_title:string,raw_file:string,text_file:string,shot_file:string,floorplan_files:array<string>,status:string,error:string>>"
RESOLVED = "query string, discovered_at string, resolved struct<found:boolean,building_name:string,building_name_local:string,project_name:string,country:string,city:string,official_website:string,developer:string,building_id_suggestion:string>"
CRAWL_LOG = ["idx", "title", "purpose", "expected_content", "url", "slug", "kind", "status", "http_status", "chars", "page_title", "raw_file", "text_file", "shot_file", "accessed_at", "error"]
FLOORPLANS = "plans array<struct<is_floorplan:boolean,plan_kind:string,matched_type_code:string,unit_label_raw:string,total_area_on_plan:double,tower_code:string,floor_range:string,floor_label:string,units_on_floor:int,rooms:array<struct<room_code:string,room_type:string,room_label_raw:string,area_m2:double,width_m:double,length_m:double,has_window:boolean,is_ensuite:boolean,position_note:string,label_on_drawing:string>>,notes:string,source_file:string>>"
PROVENANCE = "table string, record_key string, field string, value string, source_url string, source_file string, snippet string, confidence string, accessed_at string"
#: Verbatim and commentary fields that rewriting leaves alone, by name or by ending.
VERBATIM = ["design_concept", "item_spec", "room_label_raw", "amenity_name_local", "building_name_local", "type_code"]
VERBATIM_ENDINGS = ("_url", "_local", "_raw", "_note")
#: Fields by which duplicate records of a table are one.
DEDUP_KEYS = {"building": [], "unit_type": ["type_code"], "floor_plate": ["tower_code", "floor_range"], "handover_item": ["item_code"], "amenity": ["slug"], "price_obs": ["unit_type_code", "market", "period"]}
