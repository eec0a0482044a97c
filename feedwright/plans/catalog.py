"""The known feeds and coverage reports.

Dataset names, file patterns, column lists, key columns and report names below
are fixed values: runs, reports and folders of existing users carry them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cache
from graphlib import TopologicalSorter
from pathlib import Path

from feedwright.functions.text import blank_to_null, replace_text, upper_key
from feedwright.plans.spec import FeedSpec, LookupSpec, dates, fill_schemas, pad, read_schemas, without

# How dates arrive.
DASHED = ("yyyy-M-d",)
PACKED = ("yyyyMMdd",)
SLASHED = ("M/d/yy", "M/d/yyyy")

# The columns of the feeds, in file order.
SALES_COLUMNS = (
    "TransWeek,LocationNbr,ProductNbr,ClearanceSales,ClearanceUnits,CompSales,CompUnits,PromoSales,"
    "PromoUnits,RegularSales,RegularUnits,TotalSales,TotalUnits,CircularSales,CircularUnits,"
    "DiscontinuedSales,DiscontinuedUnits,TCPSales,TCPUnits"
).split(",")
INVENTORY_COLUMNS = (
    "TransWeek,LocationNbr,ProductNbr,EOHSales,EOHUnits,InStockPct,OutStockPct,BOHSales,BOHUnits,"
    "LocationActive,LocationTracked"
).split(",")
PRODUCT_COLUMNS = (
    "ProductNbr,UPC,DeptID,ClassID,ItemID,ProductName,RetailerBrand,RetailerBPMGroupBrand,"
    "RetailerSubClass,RetailerStyle,RetailerMDSECategory"
).split(",")
LOCATION_COLUMNS = (
    "LocationNbr,LocationName,Address,City,State,Zip,Zip2,LocationFormatName,Region,LocationGroup"
).split(",")
LOCATION_WITHOUT_GROUP_COLUMNS = (
    "LocationNbr,LocationName,Address,City,State,Zip,Zip2,LocationFormatName,Region"
).split(",")
PERIOD_COLUMNS = (
    "PER,SDESC,LDESC,DATE,PERIOD LEVEL,CALENDAR YEAR,CALENDAR QUARTER,CALENDAR HALF,CALENDAR MONTH,"
    "CALENDAR WEEK"
).split(",")
STORE_REGION_COLUMNS = (
    "TDLinx,Store_Name,HHs,Store_Number,Street_Address,City,State,Zip Code,"
    "Market_Name_Walmart_Large_Format_Divisions_2016,Market_Name_Walmart_CMA_Market_Names_2016,"
    "Geography_Name_Census_Region"
).split(",")
CODE_GROUP_COLUMNS = (
    "Nielsen PPG ProductTag,Nielsen PPG Desc,Nielsen UPC ProductTag,PRODUCT LEVEL,Nielsen UPC Desc,"
    "Nielsen UPC"
).split(",")

PLANOGRAM_KEYS = (
    "Store_Nbr,Planogram_Name,FileName,Send_Trait,Planogram_Height,Planogram_Width,UPC,PL_Name,"
    "PL_Category,PL_Subcategory,Merch_Group,PL_Brand,PL_Size,PL_UOM,PL_Height,PL_Width,PL_Depth,"
    "PL_CaseTotalNumber,Product_Case_total_number,Product_Height,Product_Width,Product_Depth,"
    "Position_Height,Position_Width,Position_Depth,Position_DFacings,Position_HFacings,"
    "Position_Vfacings,Position_X,Position_Y"
).split(",")
PLANOGRAM_MEASURES = [
    "PL_Size", "PL_Height", "PL_Width", "PL_Depth", "PL_CaseTotalNumber", "Product_Case_total_number",
    "Product_Height", "Product_Width", "Product_Depth", "Position_Height", "Position_Width",
    "Position_Depth", "Position_DFacings", "Position_HFacings", "Position_Vfacings", "Position_X",
    "Position_Y",
]
SCAN_COLUMNS = [
    "GEO", "UPC", "WeekEnding", "BaseDollars", "BaseDollars_AnyPromo", "BaseDollars_Display",
    "BaseDollars_FeatAndDisp", "BaseDollars_FeatAndOrDisp", "BaseDollars_Feature", "BaseDollars_NoPromo",
    "BaseDollars_TPR", "BaseUnits", "BaseUnits_AnyPromo", "BaseUnits_Display", "BaseUnits_EQ",
    "BaseUnits_EQ_AnyPromo", "BaseUnits_EQ_Display", "BaseUnits_EQ_FeatAndDisp",
    "BaseUnits_EQ_FeatAndOrDisp", "BaseUnits_EQ_Feature", "BaseUnits_EQ_NoPromo", "BaseUnits_EQ_TPR",
    "BaseUnits_FeatAndDisp", "BaseUnits_FeatAndOrDisp", "BaseUnits_Feature", "BaseUnits_NoPromo",
    "BaseUnits_TPR", "Dollars", "Dollars_AnyPromo", "Dollars_Display", "Dollars_FeatAndDisp",
    "Dollars_FeatAndOrDisp", "Dollars_Feature", "Dollars_NoPromo", "Dollars_TPR", "PACV_Discount",
    "PACV_DispWOFeat", "PACV_FeatAndDisp", "PACV_FeatWODisp", "Units", "Units_AnyPromo", "Units_Display",
    "Units_EQ", "Units_EQ_AnyPromo", "Units_EQ_Display", "Units_EQ_FeatAndDisp", "Units_EQ_FeatAndOrDisp",
    "Units_EQ_Feature", "Units_EQ_NoPromo", "Units_EQ_TPR", "Units_FeatAndDisp", "Units_FeatAndOrDisp",
    "Units_Feature", "Units_NoPromo", "Units_TPR", "ACV", "Max_PeriodEnd",
]


def _plain(name: str, raw: str, width: int, columns: Iterable[str] = (), output: str = "") -> FeedSpec:
    """Append-distinct, nothing checked."""
    return FeedSpec(name, raw, width, "append", tuple(columns), output)


def _master(name: str, raw: str, width: int, *keys: str, columns: Iterable[str] = (), **more) -> FeedSpec:
    """Upsert on checked keys that must be unique."""
    settings = {"keys": keys, "unique": keys, **more}
    return FeedSpec(name, raw, width, "upsert", tuple(columns), **settings)


def _plain_feeds() -> list[FeedSpec]:
    return [
        _plain("8451_SHCD", "/Raw/8451/8451_SHCD*.csv", 106),
        _plain("8451_Styling", "/Raw/8451/8451_STYLING*.csv", 105),
        _plain("InfoScout_Trip", "/Raw/InfoScout/ISC_TRIP*.csv", 29, output="InfoScoutTrip"),
        _plain("InfoScout_Feed", "/Raw/InfoScout/ISC_FEED*.csv", 17, output="InfoScoutFeed"),
        _plain("WalmartCalendar", "/Raw/Walmart/WMT_ALL_CAL*.csv", 22),
        _plain(
            "PeriodMappingGWTNCalendar",
            "/Raw/Mapping/MAP_ALL_PER*.csv",
            4,
            ("Gregorian", "WalmartWeek", "TargetWeek", "NielsenWeek"),
            "GWTNCalendar",
        ),
        _plain(
            "Holiday",
            "/Raw/Mapping/MAP_ALL_HOL*.csv",
            13,
            "Holiday,2009,2010,2011,2012,2013,2014,2015,2016,2017,2018,2019,2020".split(","),
        ),
        _plain("Feature_Vision", "/Raw/FeatureVision/FEV*.csv", 35),
        _plain(
            "PEA_PPG_Mapping", "/Raw/Mapping/MAP_PPG_PEA*.csv", 2, ("PEA_PPG", "Nielsen"), "PEAPPGMapping"
        ),
        FeedSpec(
            "Weather",
            "/Raw/Walmart/unilever_history_weekly_data*.csv",
            5,
            "append",
            ("zip", "date", "avgTemp", "prcp", "rh"),
            keys=("date",),
        ),
    ]


def _masters() -> list[FeedSpec]:
    return [
        _master(
            "TargetPOS_Product", "/Raw/Target/TGT_ITM*.csv", 11, "ProductNbr", columns=PRODUCT_COLUMNS
        ),
        _master(
            "TargetPOS_Location", "/Raw/Target/TGT_STR*.csv", 10, "LocationNbr", columns=LOCATION_COLUMNS
        ),
        _master(
            "Target_GRM_LOCATION",
            "/Raw/Target/TGT_GRM_STR*.csv",
            9,
            "LocationNbr",
            columns=LOCATION_WITHOUT_GROUP_COLUMNS,
            output="TargetGRMLocation",
        ),
        _master(
            "Target_GRM_PRODUCT",
            "/Raw/Target/TGT_GRM_ITM*.csv",
            15,
            "ProductNbr",
            output="TargetGRMProduct",
        ),
        _master(
            "Nielsen_Elasticity",
            "/Raw/NielsenElasticities/NLS*.csv",
            50,
            "MARKET",
            output="NielsenElasticity",
        ),
        _master(
            "GST_DEMOS",
            "/Raw/Target/TGT_GRM_DEMO*.txt",
            65,
            "GST_REF_I",
            piped=True,
            distinct_dups=True,
        ),
        _master(
            "STR_CNCPT", "/Raw/Target/TGT_GRM_STR_MKTG*.txt", 27, "CO_LOC_I", "CO_LOC_REF_I", piped=True
        ),
        _master(
            "STR_CURR",
            "/Raw/Target/TGT_GRM_STR*.txt",
            22,
            "SITE_SEQ_I",
            "STR_I",
            piped=True,
            exclude=("TGT_GRM_STR_MKTG*.txt",),
        ),
        _master(
            "ITEM_HIER", "/Raw/Target/TGT_GRM_ITM*.txt", 28, "MDSE_ITEM_I", "MDSE_ITEM_REF_I", piped=True
        ),
        _master(
            "Nielsen_DHC_Market",
            "/Raw/Nielsen/NLS_STR*.csv",
            18,
            "MKT",
            "LDESC",
            output="NielsenCustomDHCMarket",
            after=(("LDESC", upper_key), ("MKT", upper_key)),
            conform_history=True,
        ),
        _master(
            "Nielsen_Period",
            "/Raw/Nielsen/NLS_PRD*.csv",
            10,
            "DATE",
            "SDESC",
            columns=PERIOD_COLUMNS,
            output="NielsenPeriod",
            before=dates(SLASHED, "DATE"),
            date_keys=("DATE",),
            unique=("DATE",),
        ),
        _master(
            "Nielsen_Product",
            "/Raw/Nielsen/NLS_ITM*.csv",
            377,
            "PRDC_KEY",
            "PRDC_TAG",
            "PRDC_CODE",
            output="NielsenProduct",
            after=(pad("PRDC_CODE", 13),),
            unique=("PRDC_TAG", "PRDC_CODE"),
        ),
        _master(
            "TDLinx",
            "/Raw/TDLinx/TGT_TDL*.csv",
            23,
            "TDLinx",
            "Retailer Store Number",
            "ACV - Est. Yearly",
            "Latitude",
            "Longitude",
            output="TDLinkStore",
            before=(("Retailer Store Number", blank_to_null),),
            key_text="TDLinx,Retailer_Store_Number,ACV_Est_Yearly,Latitude, Longitude",
            unique=("TDLinx",),
        ),
    ]


# Fixed values per product group of one retailer: the code in file names, the
# item, store and sales dataset, their report names and their column counts.
GROUPS = [
    ("IC", "Walmart_ICECREAM_ITEM", "Walmart_Store_IceCream", "Walmart_Icecream_POS", "ICECREAM", "ICECREAM", "IceCream", 157, 180, 29),
    ("TEA", "Walmart_TEA_ITEM", "Walmart_Store_Tea", "Walmart_Tea_POS", "TEA", "TEA", "TEA", 157, 173, 29),
    ("HCS", "Walmart_ULHairOil_ITEM", "Walmart_Store_HairOil", "Walmart_Hairoil_POS", "HairOil", "HairOil", "HairOil", 155, 175, 29),
    ("SPR", "Walmart_SPREADS_ITEM", "Walmart_Store_Spreads", "Walmart_Spread_POS", "SPREADS", "SPREADS", "SPREADS", 158, 237, 29),
    ("SSC", "Walmart_USASCC_ITEM", "Walmart_Store_SASC", "Walmart_SASC_POS", "SASC", "SASC", "SASC", 183, 247, 28),
]


def _group_feeds() -> list[FeedSpec]:
    feeds = []
    for code, item, store, pos, item_out, store_out, pos_out, item_width, store_width, pos_width in GROUPS:
        feeds += [
            _master(
                item,
                f"/Raw/Walmart/WMT_{code}_ITM*.csv",
                item_width,
                "ITEM_KEY",
                "UPC",
                output=f"{item_out}_ITEM",
                before=(without("ITEM_KEY", ","),),
                key_text="ITEM_KEY, UPC",
                after=(pad("UPC", 13),),
                unique=("ITEM_KEY",),
            ),
            _master(
                store,
                f"/Raw/Walmart/WMT_{code}_STR*.csv",
                store_width,
                "RETAILER_KEY",
                "STORE_KEY",
                output=f"{store_out}_STORE",
                before=(without("STORE_KEY", ","),),
                key_text="RETAILER_KEY, STORE_KEY",
                unique=("STORE_KEY",),
            ),
            FeedSpec(
                pos,
                f"/Raw/Walmart/WMT_{code}_POS*.csv",
                pos_width,
                "range",
                output=f"{pos_out}_POS",
                before=dates(PACKED, "PERIOD_KEY"),
                keys=("ITEM_KEY", "STORE_KEY", "PERIOD_KEY"),
                date_keys=("PERIOD_KEY",),
                key_text="ITEM_KEY, STORE_KEY, PERIOD_KEY",
                lookups=(
                    LookupSpec("STORE_KEY", store, "STORE_KEY"),
                    LookupSpec("ITEM_KEY", item, "ITEM_KEY"),
                ),
                range_date="PERIOD_KEY",
            ),
        ]
    return feeds


def _mappings() -> list[FeedSpec]:
    feeds = [
        FeedSpec(
            "PriceList",
            "/Raw/Unilever/UL_PRC*.csv",
            46,
            "append",
            before=dates(PACKED, "Material_status_date"),
            keys=("UNIT_UPC",),
            after=(pad("UNIT_UPC", 13),),
        ),
        FeedSpec(
            "PEA",
            "/Raw/PEA/PEA*.csv",
            99,
            "append",
            before=dates(
                DASHED,
                "AMPS_Event_Start_Date",
                "AMPS_Event_End_Date",
                "Unadjusted_Nielsen_Start_Week",
                "Adjusted_Nielsen_Start_Week",
                "Date_Last_Updated",
            ),
            keys=("Retailer", "PPG"),
            lookups=(LookupSpec("PPG", "PEA_PPG_Mapping", "PEA_PPG"),),
            lookup_text="PPG",
            distinct_errors=True,
        ),
        FeedSpec(
            "Nielsen_Demo",
            "/Raw/Nielsen/NielsenDemographic/NLS_DMG_CNT_IDX*.csv",
            65,
            "append",
            output="Demographic",
            keys=("TDLinx", "STORE_NAME", "Latitude", "Longitude"),
            key_rule="any",
            lookups=(LookupSpec("TDLinx", "TDLinx", "TDLinx"),),
            lookup_text="TDLinx",
            distinct_errors=True,
        ),
        FeedSpec(
            "StoreRegionMapping",
            "/Raw/Mapping/MAP_STR_REG*.csv",
            11,
            "append",
            tuple(STORE_REGION_COLUMNS),
            lookups=(LookupSpec("TDLinx", "TDLinx", "TDLinx"),),
            lookup_text="TDLinx",
        ),
        FeedSpec(
            "TDLinx_Mapping",
            "/Raw/Mapping/TDL_TGT_STR_MAP*.csv",
            4,
            "append",
            ("TDLinx", "Store Name", "HHs", "Name"),
            "TDLinx_Target_Stores_Mapping",
            lookups=(LookupSpec("TDLinx", "TDLinx", "TDLinx"),),
            lookup_text="TDLinx",
        ),
        FeedSpec(
            "NielsenUPCtoPPGmapping",
            "/Raw/Mapping/MAP_UPC_PPG*.csv",
            6,
            "append",
            tuple(CODE_GROUP_COLUMNS),
            "UPC_PPG_Mapping",
            before=(pad("Nielsen UPC", 13),),
            lookups=(LookupSpec("Nielsen UPC", "Nielsen_Product", "PRDC_CODE"),),
            lookup_text="Nielsen UPC",
        ),
        FeedSpec(
            "Walmart_Assortment",
            "/Raw/Assortment/Mod/DHC*.csv",
            36,
            "file",
            keys=tuple(PLANOGRAM_KEYS),
            measures=tuple(PLANOGRAM_MEASURES),
            after=(
                ("PL_Name", lambda c: replace_text(c, ("&", "and"))),
                ("PL_Category", lambda c: replace_text(c, (" ", "_"))),
                ("PL_Subcategory", lambda c: replace_text(c, (" ", "_"))),
                ("Merch_Group", lambda c: replace_text(c, (" ", "_"))),
                ("PL_Brand", lambda c: replace_text(c, ("`", ""))),
            ),
            lookups=(
                LookupSpec("Store_Nbr", "Walmart_Store_HairOil", "STORE_KEY"),
                LookupSpec("UPC", "Walmart_ULHairOil_ITEM", "UPC"),
            ),
            lookup_text="Store_Nbr,UPC",
            distinct_errors=True,
        ),
    ]
    # Assortment trees by name, file code, key column and width.
    trees = [
        ("Personal_Wash", "/Raw/Target/TGT_CDT_PW*.csv", "ID", 6, ""),
        ("Hair", "/Raw/Target/TGT_CDT_HC*.csv", "A_TGT_F_DPCI", 7, ""),
        ("Deo", "/Raw/Target/Target_CDT/TGT_CDT_DEO*.csv", "DPCI", 7, ""),
        ("Ice_Cream", "/Raw/Target/TGT_CDT_IC*.csv", "ProductNbr", 9, "TargetCDT_IceCream"),
        ("Tea", "/Raw/Target/TGT_CDT_TEA*.csv", "DPCI", 7, ""),
    ]
    for tree, raw, key, width, output in trees:
        feeds.append(
            FeedSpec(
                f"TargetCDT_{tree}",
                raw,
                width,
                "append",
                output=output,
                before=(without(key, "-"), pad(key, 9)),
                keys=(key,),
                lookups=(LookupSpec(key, "TargetPOS_Product", "ProductNbr"),),
                lookup_text=key,
                distinct_errors=True,
            )
        )
    return feeds


def _weekly_facts() -> list[FeedSpec]:
    stores = (
        LookupSpec("ProductNbr", "TargetPOS_Product", "ProductNbr"),
        LookupSpec("LocationNbr", "TargetPOS_Location", "LocationNbr"),
    )

    def store_fact(name: str, raw: str, columns: list[str]) -> FeedSpec:
        return FeedSpec(
            name,
            raw,
            len(columns),
            "range",
            tuple(columns),
            before=dates(DASHED, "TransWeek"),
            keys=("LocationNbr", "ProductNbr", "TransWeek"),
            date_keys=("TransWeek",),
            key_text="LocationNbr, ProductNbr, TransWeek",
            lookups=stores,
            range_date="TransWeek",
        )

    def basket(column: str, dataset: str, key: str) -> LookupSpec:
        return LookupSpec(column, dataset, key, f"{column} when mapped to {dataset}.{key}")

    return [
        store_fact("TargetPOS_Sales", "/Raw/Target/TGT_POS*.csv", SALES_COLUMNS),
        store_fact("TargetPOS_Inventory", "/Raw/Target/TGT_INV*.csv", INVENTORY_COLUMNS),
        FeedSpec(
            "Nielsen_Scan_UPC",
            "/Raw/Nielsen/NLS_SYN*.csv",
            57,
            "range",
            tuple(SCAN_COLUMNS),
            "NielsenScantrack",
            before=(pad("UPC", 13), *dates(DASHED, "WeekEnding", "Max_PeriodEnd")),
            keys=("GEO", "UPC", "WeekEnding"),
            date_keys=("WeekEnding",),
            key_text="GEO, UPC, WEEKENDING",
            lookups=(
                LookupSpec("UPC", "Nielsen_Product", "PRDC_CODE"),
                LookupSpec("WeekEnding", "Nielsen_Period", "DATE", "WEEKENDING"),
                LookupSpec("GEO", "Nielsen_DHC_Market", "LDESC", ignore_case=True),
            ),
            range_date="WeekEnding",
        ),
        FeedSpec(
            "Nielsen_PPG",
            "/Raw/Nielsen/NLS_PPG*.csv",
            59,
            "range",
            before=dates(DASHED, "WeekEnding"),
            keys=("GEO", "Tag", "WeekEnding"),
            date_keys=("WeekEnding",),
            lookups=(
                LookupSpec("GEO", "Nielsen_DHC_Market", "MKT", ignore_case=True),
                LookupSpec("Tag", "Nielsen_Product", "PRDC_TAG"),
                LookupSpec("WeekEnding", "Nielsen_Period", "DATE"),
            ),
            range_date="WeekEnding",
        ),
        FeedSpec(
            "Target_GRM",
            "/Raw/Target/TGT_GRM_POS*.txt",
            19,
            "range",
            output="TargetGRMTrans",
            piped=True,
            before=dates(DASHED, "SLS_D"),
            keys=("GST_REF_I", "MDSE_ITEM_I", "MDSE_ITEM_REF_I", "SLS_D", "CO_LOC_I", "CO_LOC_REF_I"),
            date_keys=("SLS_D",),
            key_text="GST_REF_I, MDSE_ITEM_I, MDSE_ITEM_REF_I,SLS_D,CO_LOC_I,CO_LOC_REF_I",
            lookups=(
                basket("GST_REF_I", "GST_DEMOS", "GST_REF_I"),
                basket("CO_LOC_REF_I", "STR_CNCPT", "CO_LOC_REF_I"),
                basket("CO_LOC_REF_I", "STR_CURR", "STR_I"),
                basket("CO_LOC_I", "STR_CNCPT", "CO_LOC_I"),
                basket("CO_LOC_I", "STR_CURR", "SITE_SEQ_I"),
                basket("MDSE_ITEM_I", "ITEM_HIER", "MDSE_ITEM_I"),
                basket("MDSE_ITEM_REF_I", "ITEM_HIER", "MDSE_ITEM_REF_I"),
            ),
            range_date="SLS_D",
        ),
    ]


# Coverage reports: the report's name, the dataset whose snapshot it reads and
# the dated column it reports on.
COVERAGE = {
    "WMPOS_Tea_MissingWk": ("Walmart_Tea_POS", "PERIOD_KEY"),
    "WMPOS_HairOil_MissingWk": ("Walmart_Hairoil_POS", "PERIOD_KEY"),
    "WMPOS_IceCream_MissingWk": ("Walmart_Icecream_POS", "PERIOD_KEY"),
    "WMPOS_Spreads_MissingWk": ("Walmart_Spread_POS", "PERIOD_KEY"),
    "WMPOS_SASC_MissingWk": ("Walmart_SASC_POS", "PERIOD_KEY"),
    "Nielsen_Scan_UPC_MissingWk": ("Nielsen_Scan_UPC", "WeekEnding"),
    "TargetPOS_Sales_MissingWk": ("TargetPOS_Sales", "TransWeek"),
    "TargetPOS_inventory_MissingWk": ("TargetPOS_Inventory", "TransWeek"),
    "Target_GRM_MissingWk": ("Target_GRM", "SLS_D"),
    "Nielsen_PPG_MissingWk": ("Nielsen_PPG", "WeekEnding"),
}


def _base(glob: str) -> tuple[str, str]:
    head, _, tail = glob.partition("*")
    return head, tail


def check_globs(specs: Iterable[FeedSpec]) -> None:
    """No raw file may belong to two feeds, unless one of them excludes it."""
    listed = [(s.name, *_base(s.raw_glob), s) for s in specs]
    for name, head, tail, _ in listed:
        for other, other_head, other_tail, spec in listed:
            overlap = name != other and tail == other_tail and head.startswith(other_head)
            if overlap and f"{head.rsplit('/', 1)[-1]}*{tail}" not in spec.exclude:
                raise ValueError(f"files of {name} also match {other}")


def feeds() -> dict[str, FeedSpec]:
    """Every feed by dataset name."""
    listed = _plain_feeds() + _masters() + _group_feeds() + _mappings() + _weekly_facts()
    check_globs(listed)
    return fill_schemas({s.name: s for s in listed}, declared_columns())


@cache
def declared_columns() -> dict[str, str]:
    """The columns of narrow feeds, from the file beside this module."""
    return read_schemas(Path(__file__).with_name("feed_columns.txt").read_text(encoding="utf-8").splitlines())


def load_order(specs: Mapping[str, FeedSpec]) -> list[str]:
    """Datasets with every master ahead of the feeds that look it up."""
    needs = {n: {lookup.dataset for lookup in s.lookups} & set(specs) for n, s in specs.items()}
    return list(TopologicalSorter(needs).static_order())
