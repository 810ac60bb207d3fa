"""Schemas of every input, as DDL."""

# fixed values: field names as the inputs carry them
ELEMENT = ("type string, id bigint, lat double, lon double, center struct<lat:double,lon:double>, "
           "tags map<string,string>")
POI_ROW = ("osm_type string, osm_id bigint, name string, category string, subtype string, cuisine string, "
           "addr string, postal string, lat double, lon double, website string, phone string, opening_hours string")
FEATURE = ("type string, properties struct<name:string,kind:string,nhood:string>, "
           "geometry struct<type:string,coordinates:string>")
OVERLAY_FIELDS = ("price int, verdict string, applePay boolean, laptops boolean, notes string, menu string, "
                  "verified string")
EXTRA = ("name string, category string, subtype string, addr string, lat double, lon double, " + OVERLAY_FIELDS)
INCIDENT = ("row_id string, incident_id string, incident_number string, incident_datetime string, "
            "incident_code string, incident_category string, incident_subcategory string, "
            "incident_description string, resolution string, police_district string, "
            "analysis_neighborhood string, latitude string, longitude string")
SCORED = ("business_id string, business_name string, business_address string, postal string, lat string, lon string, "
          "inspection_id string, inspection_date string, inspection_score string, inspection_type string, "
          "violation_id string, violation_description string, risk_category string")
PLACARD = ("inspection_id string, name string, address string, postal string, lat string, lon string, date string, "
           "facility_status string, inspection_type string, violation_observed string, description string")
CURRENT = ("permit_number string, dba string, street_address string, lat string, lon string, inspection_date string, "
           "inspection_type string, facility_rating_status string, violation_count string, violation_codes string, "
           "inspection_notes string, suspension_notes string, analysis_neighborhood string, data_as_of string")
PROFILE = ("source string, dataset_id string, as_of string, rows bigint, date_min string, date_max string, "
           "date_max_not_after_today string, future_dated_rows bigint, raw_bytes bigint")
MENU = ("name string, addr string, menu_url string, source string, as_of string, status string, "
        "items array<struct<section:string,item:string,price:double,description:string>>, notes string, "
        "price_level_estimate int, price_level_basis string, "
        "extraction struct<method:string,model:string,prompt_hash:string,path:string>")
PRODUCTS = ("name string, addr string, source_url string, source string, as_of string, status string, "
            "extraction struct<method:string,path:string,pulled_at:string>, "
            "products array<struct<section:string,name:string,description:string,size:string,price:double,"
            "sold_by:string,package_g:double,package_ml:double,units:int>>")
TAG_READING = ("key string, basis string, at string, models array<string>, "
               "samples array<struct<a:string,w:map<string,array<string>>,refusal:boolean>>")
MAP_READING = ("key string, basis string, at string, candidates array<bigint>, models array<string>, "
               "samples array<struct<c:string,p:string,refusal:boolean>>")
RECORD = ("fdcId bigint, dataType string, description string, publicationDate string, fetched_at string, "
          "nutrients array<struct<id:int,number:string,name:string,unit:string,amount:double>>, "
          "portions array<struct<description:string,gram_weight:double>>")
LABEL = ("id string, source string, as_of string, serving string, serving_g double, "
         "nutrients array<struct<name:string,unit:string,amount:double>>")
FOOD_MAP = ("id string, kind string, estimate boolean, key string, fdcId bigint, dataType string, category string, "
            "description string, agree int, grams double, grams_basis string, label string, reason string")
GROCERY = "food string, fdcId bigint"
BULK = {
    "nutrient": "id string, name string, unit_name string, nutrient_nbr string, rank string",
    "food": "fdc_id string, data_type string, description string, food_category_id string, publication_date string",
    "food_nutrient": "id string, fdc_id string, nutrient_id string, amount string",
    "food_portion": ("id string, fdc_id string, seq_num string, amount string, measure_unit_id string, "
                     "portion_description string, modifier string, gram_weight string"),
    "measure_unit": "id string, name string",
    "food_category": "id string, code string, description string",
    "wweia_food_category": "wweia_food_category string, wweia_food_category_description string",
}
