"""Category lists that fix the feature schema.

Fixed values: these lists name the output columns, so they are part of the data contract.
Every aggregator takes its list as a parameter; these are the defaults.
"""

ROAD_CLASSES = (
    "bridleway cycleway footway living_street motorway path pedestrian primary residential "
    "secondary service steps tertiary track trunk unclassified unknown").split()

ROAD_SUBCLASSES = "sidewalk crosswalk link driveway parking_aisle alley steps".split()

ROAD_SURFACES = (
    "paved asphalt concrete unpaved gravel dirt compacted cobblestone sett metal wood ground"
).split()

PAVED_SURFACES = "paved asphalt concrete sett cobblestone metal".split()

UNPAVED_SURFACES = "unpaved gravel dirt compacted ground wood".split()

BUILDING_CLASSES = (
    "allotment_house apartments barn beach_hut boathouse bridge_structure bungalow bunker cabin "
    "carport cathedral chapel church civic college commercial cowshed detached dormitory factory "
    "farm farm_auxiliary fire_station garage garages government grandstand greenhouse guardhouse "
    "hangar hospital hotel house hut industrial kindergarten kiosk library manufacture military "
    "monastery mosque office outbuilding parking pavilion post_office presbytery public religious "
    "residential retail roof school semidetached_house service shed silo sports_centre sports_hall "
    "stable stadium static_caravan storage_tank supermarket synagogue temple terrace toilets "
    "train_station transformer_tower transportation university unknown warehouse").split()

POI_CATEGORIES = (
    "professional_services cafe park beauty_salon automotive_repair restaurant clothing_store gym "
    "hair_salon real_estate_agent contractor church_cathedral home_service "
    "community_services_non_profits dentist coffee_shop bakery corporate_office retail "
    "furniture_store financial_service real_estate pharmacy doctor construction_services "
    "fast_food_restaurant bar shopping education hotel pet_service insurance_agency auto_dealer "
    "pizza_restaurant child_care supermarket accounting plumber event_planning "
    "flowers_and_gifts_shop sports_club_and_league gas_station liquor_store accountant "
    "physical_therapy massage tattoo_shop nail_salon dry_cleaning photographer").split()

LANDUSE_CLASSES = (
    "airfield allotments animal_keeping aquaculture bare_rock barracks base basin bay beach "
    "brownfield bunker camp_site canal cape cemetery cliff clinic college commercial construction "
    "danger_area ditch doctors dog_park drain driving_range driving_school dune education fairway "
    "farmland farmyard fell fishpond flowerbed forest garages garden golf_course grass grassland "
    "grave_yard green greenfield greenhouse_horticulture heath hospital industrial institutional "
    "island islet kindergarten lagoon lake land landfill lateral_water_hazard marina meadow "
    "military moat mountain_range national_park natural_monument nature_reserve obstacle_course "
    "ocean orchard park pedestrian pitch plant_nursery plateau playground plaza pond protected "
    "protected_landscape_seascape quarry railway range recreation_ground reef reflecting_pool "
    "religious reservoir residential resort retail river rock rough sand school schoolyard scree "
    "scrub shingle shrubbery species_management_area stadium stone strait stream "
    "strict_nature_reserve swimming_pool tee theme_park track traffic_island training_area "
    "tree_row university valley village_green vineyard wastewater water water_hazard water_park "
    "wetland wilderness_area wood works zoo").split()

GREEN_LANDUSE = (
    "forest grass meadow recreation_ground park nature_reserve wood scrub wetland grassland "
    "garden farmland orchard vineyard").split()

BUILT_LANDUSE = (
    "residential commercial industrial retail construction institutional military railway "
    "education medical transportation").split()

INFRASTRUCTURE_CLASSES = (
    "artwork atm barrier bench bicycle_parking bicycle_rental bollard bridge bus_station bus_stop "
    "charging_station communication_tower crossing dam drinking_water fence fire_hydrant fountain "
    "gate generator information manhole monitoring parking picnic_table pier pipeline platform "
    "post_box power_line power_pole power_tower railway_station recycling street_cabinet "
    "street_lamp substation subway_station toilets traffic_signals vending_machine wall "
    "waste_basket").split()

LAND_COVER_SUBTYPES = "barren crop forest grass mangrove moss shrub snow urban wetland".split()

GREEN_LAND_COVER = "forest grass shrub mangrove moss wetland".split()

NATIONAL_NETWORKS = (
    "US:I US:US AU:N AU:A GB:M GB:A DE:B FR:N FR:A IT:A ES:A JP:N NZ:SH CA:T").split()

# Columns that get a log1p companion: every column with one of the prefixes, and the named ones.
LOG1P_PREFIXES = (
    "poi_count_ road_length_ building_count_ building_area_ landuse_area_ infra_count_ "
    "landcover_area_ building_part_ road_surface_length_").split()

LOG1P_COLUMNS = (
    "poi_count_total poi_category_diversity poi_alt_category_diversity total_road_length_m "
    "building_total_area_m2 landuse_total_area_m2 address_count_total address_unique_streets "
    "infra_count_total infra_class_diversity landcover_total_area_m2 connector_count_total "
    "connector_density_per_km2 building_part_count building_part_total_area_m2 division_count "
    "division_area_count division_boundary_length_m bathymetry_area_m2 unique_road_names "
    "route_count_total").split()

INDICATORS = {
    "pct_is_bridge_length": "has_bridge",
    "pct_is_tunnel_length": "has_tunnel",
    "pct_is_link_length": "has_link",
    "pct_is_under_construction_length": "has_under_construction",
    "has_access_restriction_pct": "has_access_restrictions",
    "pct_access_denied_foot_length": "has_foot_restriction",
    "pct_access_denied_bicycle_length": "has_bicycle_restriction",
    "pct_access_denied_hgv_length": "has_hgv_restriction",
}
