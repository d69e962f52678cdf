"""Small hand-made feeds for the tests."""

from lotbook.sources.feeds import OFFLINE, ONLINE, conformed_union, stage
from lotbook.sources.scratch import new_folder

_OFFLINE_ROW = {
    "id": "100", "date": "2022-06-01", "salespersonid": "AnnLee", "salesperson": "Ann Lee",
    "customername": "Bo Diaz", "customercountry": "Norway", "customerstate": "Viken",
    "customerpostalcode": "N1", "customercity": "Moss", "customerstreetname": "Elm",
    "customerbuildingnumber": "7", "customertelephonenumber": "555-1", "customeremail": "bo@x.no",
    "carmake": "Fiat", "carmodel": "Panda", "caryear": "2015", "saleprice": "200.00",
    "commissionrate": "0.1", "commissionearned": "20.00", "paymentmethod": "Cash", "saleschannel": "Offline",
    "cardelername": "North Cars",
}
_ONLINE_ROW = {
    "id": "900", "date_of_transaction": "2022-07-01", "employee_id": "CyPratt", "employee": "Cy Pratt",
    "customer_name_and_surname": "Di Roe", "customer_country": "norway ", "customer_state": "viken",
    "customer_postal_code": "N2", "customer_city": "moss", "customer_street_name": "Oak",
    "customer_building_number": "9", "customer_telephone_number": "555-2", "customer_email": "di@x.no",
    "brand": "fiat", "car_model": " panda", "car_year": "2015", "car_price": "300.00",
    "reduction_percent": "0.10", "income": "30.00", "payment_method": "Card", "sales_channel": "Online",
    "car_dealer_name": "north cars",
}


def offline(spark, *changes):
    data = [tuple((_OFFLINE_ROW | change)[c] for c in OFFLINE.columns.values()) for change in changes]
    return spark.createDataFrame(data, OFFLINE.schema)


def online(spark, *changes):
    data = [tuple((_ONLINE_ROW | change)[c] for c in ONLINE.columns.values()) for change in changes]
    return spark.createDataFrame(data, ONLINE.schema)


def feed(spark, offline_changes=({},), online_changes=({},)):
    """Staged and conformed."""
    left = stage(offline(spark, *offline_changes).coalesce(1), new_folder(spark, "offline"))
    right = stage(online(spark, *online_changes).coalesce(1), new_folder(spark, "online"))
    return conformed_union(left, right)
