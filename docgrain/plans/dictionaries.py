"""Dictionaries of equipment, amenities and field labels. Everything in this file is a fixed value."""

from __future__ import annotations

#: term, item_code, item_category
HANDOVER = [
    ("食器洗い乾燥機", "may_rua_bat", "bep"),
    ("ディスポーザー", "may_nghien_rac", "bep"),
    ("生ゴミディスポーザー", "may_nghien_rac", "bep"),
    ("IHクッキングヒーター", "bep_tu", "bep"),
    ("ガスコンロ", "bep_gas", "bep"),
    ("レンジフード", "may_hut_mui", "bep"),
    ("浄水器", "may_loc_nuoc", "bep"),
    ("人造大理石", "mat_bep_da_nhan_tao", "bep"),
    ("御影石", "mat_bep_da_granite", "bep"),
    ("ミストサウナ", "xong_hoi_uot", "thiet_bi_ve_sinh"),
    ("浴室暖房乾燥機", "suoi_say_phong_tam", "thiet_bi_ve_sinh"),
    ("追い焚き", "ham_nong_nuoc_tam", "thiet_bi_ve_sinh"),
    ("温水洗浄便座", "bon_cau_voi_rua", "thiet_bi_ve_sinh"),
    ("タンクレストイレ", "bon_cau_khong_ket", "thiet_bi_ve_sinh"),
    ("洗面化粧台", "ban_lavabo", "thiet_bi_ve_sinh"),
    ("床暖房", "san_suoi", "dieu_hoa_thong_gio"),
    ("全館空調", "dieu_hoa_trung_tam", "dieu_hoa_thong_gio"),
    ("24時間換気システム", "thong_gio_24h", "dieu_hoa_thong_gio"),
    ("二重床", "san_doi", "san"),
    ("二重天井", "tran_doi", "tuong_tran"),
    ("ペアガラス", "kinh_hop", "cua"),
    ("複層ガラス", "kinh_nhieu_lop", "cua"),
    ("Low-Eガラス", "kinh_low_e", "cua"),
    ("オートロック", "khoa_tu_dong_sanh", "an_ninh_pccc"),
    ("ハンズフリーキー", "khoa_hands_free", "an_ninh_pccc"),
    ("防犯カメラ", "camera_an_ninh", "an_ninh_pccc"),
    ("TVモニター付インターホン", "chuong_hinh", "an_ninh_pccc"),
    ("24時間有人管理", "quan_ly_24h", "an_ninh_pccc"),
    ("宅配ボックス", "tu_nhan_hang", "thiet_bi_dien"),
    ("EV充電", "tram_sac_xe_dien", "thiet_bi_dien"),
    ("ウォークインクローゼット", "tu_ao_di_vao", "cua"),
    ("シューズインクローゼット", "tu_giay_di_vao", "cua"),
    ("エレベーター", "thang_may", "thang_may"),
    ("システムキッチン", "bep_lien_hoan", "bep"),
    ("カウンターキッチン", "bep_quay", "bep"),
    ("天然石カウンター", "mat_ban_da_tu_nhien", "bep"),
    ("節水シャワー", "bat_sen_tiet_kiem", "thiet_bi_ve_sinh"),
    ("シャワー水栓", "voi_sen", "thiet_bi_ve_sinh"),
    ("手洗いカウンター", "ban_rua_tay", "thiet_bi_ve_sinh"),
    ("ユニットバス", "phong_tam_lien_khoi", "thiet_bi_ve_sinh"),
    ("フローリング", "san_go", "san"),
    ("高遮音床", "san_cach_am", "san"),
    ("対震ドア枠", "khung_cua_chong_dong_dat", "cua"),
    ("網戸", "cua_luoi", "cua"),
    ("玄関収納", "tu_giay_sanh", "cua"),
    ("火災感知器", "dau_bao_chay", "an_ninh_pccc"),
    ("スプリンクラー", "sprinkler", "an_ninh_pccc"),
    ("防災備品", "vat_tu_phong_chong_thien_tai", "an_ninh_pccc"),
    ("非常用発電機", "may_phat_dien_du_phong", "thiet_bi_dien"),
    ("太陽光発電", "dien_mat_troi", "thiet_bi_dien"),
    ("電気自動車充電設備", "tram_sac_xe_dien", "thiet_bi_dien"),
    ("ブロードバンド", "ha_tang_internet", "thiet_bi_dien"),
    ("インターネット", "ha_tang_internet", "thiet_bi_dien"),
    ("洗濯機置場", "cho_dat_may_giat", "thiet_bi_dien"),
    ("ZEH", "chung_nhan_zeh", "thiet_bi_dien"),
    ("スマートロック", "khoa_thong_minh", "smart_home"),
    ("スマートホーム", "smart_home", "smart_home"),
    ("制振", "ket_cau_giam_chan", "an_ninh_pccc"),
]

OPTION_HINTS = ("オプション", "有償", "別途", "無償ではありません", "選択可能", "メニュープラン", "アップグレード")

#: term, slug, amenity_category, whether indoors (none: either)
AMENITY = [
    ("ラウンジ", "lounge", "cong_dong_su_kien", True),
    ("スカイラウンジ", "sky_lounge", "cong_dong_su_kien", True),
    ("ゲストルーム", "guest_room", "cong_dong_su_kien", True),
    ("パーティールーム", "party_room", "cong_dong_su_kien", True),
    ("フィットネス", "fitness", "the_thao_gym", True),
    ("ジム", "gym", "the_thao_gym", True),
    ("プール", "pool", "be_boi", True),
    ("キッズルーム", "kids_room", "tre_em", True),
    ("スタディルーム", "study_room", "khong_gian_lam_viec", True),
    ("ワークスペース", "work_space", "khong_gian_lam_viec", True),
    ("コワーキング", "coworking", "khong_gian_lam_viec", True),
    ("ライブラリー", "library", "van_hoa_nghe_thuat", True),
    ("シアタールーム", "theater_room", "van_hoa_nghe_thuat", True),
    ("コンシェルジュ", "concierge", "dich_vu_le_tan", True),
    ("トランクルーム", "trunk_room", "do_xe", True),
    ("駐輪場", "bike_parking", "do_xe", None),
    ("機械式駐車場", "mechanical_parking", "do_xe", None),
    ("駐車場", "parking", "do_xe", None),
    ("屋上庭園", "rooftop_garden", "canh_quan_vuon", False),
    ("中庭", "courtyard", "canh_quan_vuon", False),
    ("ドッグラン", "dog_run", "thu_cung", False),
    ("ペット足洗い場", "pet_wash", "thu_cung", True),
    ("スパ", "spa", "suc_khoe_spa", True),
    ("サウナ", "sauna", "suc_khoe_spa", True),
    ("エントランスホール", "entrance_hall", "cong_dong_su_kien", True),
    ("宅配ボックス", "delivery_box", "dich_vu_le_tan", True),
    ("フロントサービス", "front_service", "dich_vu_le_tan", True),
    ("コーチエントランス", "coach_entrance", "dich_vu_le_tan", False),
    ("クリーンステーション", "waste_station", "dich_vu_le_tan", True),
    ("ゴミ置場", "waste_station", "dich_vu_le_tan", True),
    ("防災倉庫", "disaster_storage", "dich_vu_le_tan", True),
    ("自転車置場", "bike_parking", "do_xe", None),
    ("バイク置場", "motorbike_parking", "do_xe", None),
    ("カーシェア", "car_share", "do_xe", None),
    ("保育所", "nursery", "tre_em", True),
    ("保育園", "nursery", "tre_em", True),
    ("デイサービス", "day_care", "suc_khoe_spa", True),
    ("会議室", "meeting_room", "khong_gian_lam_viec", True),
    ("キッチンスタジオ", "kitchen_studio", "cong_dong_su_kien", True),
    ("カラオケ", "karaoke", "van_hoa_nghe_thuat", True),
    ("音楽室", "music_room", "van_hoa_nghe_thuat", True),
    ("ゴルフレンジ", "golf_range", "the_thao_gym", True),
    ("ペット飼育可", "pet_allowed", "thu_cung", None),
]

SIGNATURE_TERMS = ("免震構造", "制震構造", "耐震構造", "二重床", "二重天井", "アウトフレーム工法", "スカイラウンジ", "屋上庭園", "スカイデッキ")

#: Labels of each field of a building, in order of priority.
FIELD_LABELS = {
    "address": ("所在地", "住所"),
    "num_units_total": ("総戸数", "総区画数"),
    "structure": ("構造・階数", "構造および階数", "構造規模", "階建", "構造"),
    "land_area_m2": ("敷地面積",),
    "gfa_m2": ("延床面積", "延べ床面積", "建築延床面積"),
    "handover": ("引き渡し", "引渡", "入居予定", "入居時期"),
    "completion": ("竣工", "完成時期", "築年月", "建築年月", "建物竣工"),
    "launch": ("販売開始", "販売スケジュ"),
    "developer": ("売主", "事業主", "分譲会社", "販売会社"),
    "architect": ("設計会社", "設計者", "設計・監理", "設計"),
    "kind": ("種別", "物件種別"),
    "parking": ("駐車場",),
    "price": ("販売価格", "予定販売価格", "価格帯", "予定価格"),
    "period": ("情報更新日", "情報公開日", "販売スケジュ", "取引条件の有効期限"),
}
TYPE_LABELS = ("タイプ", "プラン", "住戸タイプ", "間取りタイプ", "TYPE", "Type")
