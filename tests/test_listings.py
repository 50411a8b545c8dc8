"""normalize_listings on whole scraped rows."""

from tenement.functions.listing import normalize_listings

SCHEMA = """house_id string, http int, url string, error boolean, breadcrumb array<string>, rough_address string, deal_time array<string>, property_type string, building_type string, floor string,
floor_ping string, price string, deposit string, misc map<string,array<string>>, rule string, tags array<string>, supported_facility array<string>, unsupported_facility array<string>,
rough_coordinate string, author_name string, author_phone string, agent_org string"""


def test_normalize_listings(spark):
    home = ("1", 200, "u", False, ["A市", "B區", "整層住家"], "road", None, "2房1廳1衛", "透天厝", "3F/12F", "20坪", "20,000~18,000元/月", "押金二個月",
            {"租金含": ["水費"], "管理費": ["1000", "元/月"], "車位費": ["500"], "產權登記": ["已辦理"]}, "適合學生", ["可開伙"], ["1陽台", "床"], ["冷氣", "陽台"], "24.5,121.5", "仲介: X", "09-12", "經紀業: 不動產經紀業")
    rows = [home, ("2", 404, *[None] * 20), ("3", 400, *[None] * 20), ("4", 200, "u", True, *[None] * 18),
            ("5", 200, "u", False, ["A市", "Z區", "車位"], "road", ["3天"], None, None, "B1/3F", None, "900", None, {}, None, None, None, None, None, None, None, None),
            ("6", 200, "u", False, ["C市"], None, None, None, None, None, None, "ask", "兩個月", {}, None, None, [], [], None, "X", None, None)]
    regions = spark.createDataFrame([("A市", 1), ("A市B區", 100)], "name string, code int")
    got = {r.vendor_house_id: r.asDict(recursive=True) for r in normalize_listings(spark.createDataFrame(rows, SCHEMA), regions).collect()}
    assert set(got) == {"1", "2", "4", "5", "6"} and got["2"]["deal_status"] == got["4"]["deal_status"] == 1 and got["5"]["deal_status"] == 2
    want = {"top_region": 1, "sub_region": 100, "property_type": 0, "monthly_price": 20000.0, "min_monthly_price": 18000.0, "building_type": 1, "deposit_type": 0, "n_month_deposit": 2.0, "deposit": 40000.0,
            "is_require_management_fee": True, "monthly_management_fee": 1000.0, "has_parking": True, "is_require_parking_fee": True, "monthly_parking_fee": 500.0, "per_ping_price": 1075.0, "floor": 3,
            "total_floor": 12, "is_rooftop": False, "dist_to_highest_floor": 9, "n_balcony": 1, "n_bed_room": 2, "n_living_room": 1, "n_bath_room": 1, "apt_feature_code": "01010201",
            "has_tenant_restriction": False, "can_cook": True, "allow_pet": None, "has_registration": True, "facilities": {"床": True, "冷氣": False}, "rough_coordinate": {"x": 24.5, "y": 121.5},
            "contact": 2, "author": "0912", "agent_org": "未認證", "present": ["contact", "author", "agent_org"], "parse_errors": []}
    assert {k: got["1"][k] for k in want} == want and got["1"]["additional_fee"]["water"] is False and got["1"]["additional_fee"]["gas"] is True
    assert (got["5"]["sub_region"], got["5"]["property_type"], got["5"]["floor"], got["5"]["per_ping_price"]) == (65535, 4, None, None)
    assert got["6"]["parse_errors"] == ["price", "breadcrumb", "deposit", "author_name"] and got["6"]["top_region"] == 65535
    assert got["2"]["monthly_price"] is None and got["2"]["parse_errors"] == []
