"""Small invented source rows with known answers."""

from datetime import date, datetime
from decimal import Decimal

AS_OF = date(2026, 10, 1)
LOADED = datetime(2026, 10, 1, 6, 0, 0, 700000)

EXTRACT_SCHEMA = (
    "patient_id bigint, given_name string, family_name string, birth_date date, city string, encounter_id bigint, "
    "encounter_date date, department_id int, department_name string, cost decimal(12,2)"
)
_P = {
    1001: ("Ada", "Ash", date(1980, 1, 2), "London"),
    1002: ("Ben", "Birch", date(1975, 5, 6), "Leeds"),
    1003: ("Cy", "Cedar", date(1990, 7, 8), "Bristol"),
    1004: ("Di", "Dogwood", date(2001, 9, 9), "York"),
}
_D = {10: "Outpatients", 20: "Radiology"}
EXTRACT = [
    (p, *_P[p], e, d, n, _D.get(n), None if c is None else Decimal(c))
    for p, e, d, n, c in [
        (1001, 5001, date(2026, 9, 1), 10, 120),
        (1001, 5002, date(2026, 9, 2), 20, 250),
        (1002, 5003, date(2026, 9, 2), 10, 100),
        (1003, 5004, date(2026, 9, 3), 20, 300),
        (1004, None, None, None, None),
    ]
]

PATIENT_SCHEMA = "patient_id bigint, given_name string, family_name string, birth_date date, city string, email string"
CITIES = ["London", "Leeds", "Bristol", "York", "Manchester", "Bath"]
PATIENTS = [
    (1001 + i, f"Given{i}", f"Family{i}", date(1980 + i, 1, 1), city, None if i == 5 else f"p{i}@example.test")
    for i, city in enumerate(CITIES)
]
DOCTOR_SCHEMA = (
    "doctor_id bigint, given_name string, family_name string, specialty string, email string, is_active boolean"
)
DOCTORS = [
    (201 + i, f"Doc{i}", f"Tor{i}", specialty, f"d{i}@example.test", True)
    for i, specialty in enumerate(["General Practice", "Cardiology", "Dermatology"])
]
APPOINTMENT_SCHEMA = (
    "appointment_id bigint, patient_id bigint, doctor_id bigint, starts_at timestamp_ntz, ends_at timestamp_ntz, "
    "status string, reason string, cost decimal(10,2)"
)


def _at(day, hour, minute):
    return datetime(2026, 9, day, hour, minute)


APPOINTMENTS = [
    (a, p, d, _at(day, h, 0), _at(day, h, m), status, "check", Decimal(c))
    for a, p, d, day, h, m, status, c in [
        (5001, 1001, 201, 1, 9, 30, "Completed", 60),
        (5002, 1001, 202, 2, 10, 45, "Completed", 150),
        (5003, 1002, 203, 3, 11, 30, "Completed", 90),
        (5004, 1003, 201, 4, 14, 30, "NoShow", 0),
        (5005, 1004, 202, 5, 9, 45, "Cancelled", 0),
        (5006, 1005, 201, 14, 10, 30, "Scheduled", 60),
        (5007, 1002, 203, 15, 11, 30, "Scheduled", 75),
        (5008, 1003, 202, 16, 14, 45, "Scheduled", 150),
    ]
]

_CUSTOMERS = {101: ("Cust A", "London", "GB"), 102: ("Cust B", "Manchester", "GB"), 103: ("Cust C", "New York", "US")}
_PRODUCTS = {
    201: ("Keyboard", "Accessories"), 202: ("Monitor", "Hardware"), 203: ("Laptop", "Hardware"),
    204: ("USB Cable", "Accessories"),
}
_STORES = {301: ("Central", "London"), 302: ("Northern", "Leeds")}
SALES_SCHEMA = (
    "order_id bigint, line_number int, customer_id bigint, customer_name string, customer_city string, "
    "country_code string, product_id bigint, product_name string, category_name string, store_id bigint, "
    "store_name string, store_city string, order_date date, order_status string, quantity int, unit_price decimal(12,2)"
)
SALES = [
    (o, n, c, *_CUSTOMERS[c], p, *_PRODUCTS[p], s, *_STORES[s], date(2026, 9, day), status, q, Decimal(price))
    for o, n, c, p, s, day, status, q, price in [
        (4001, 1, 101, 201, 301, 1, "Completed", 2, "45.00"),
        (4001, 2, 101, 204, 301, 1, "Completed", 3, "12.50"),
        (4002, 1, 102, 203, 302, 2, "Completed", 1, "950.00"),
        (4003, 1, 103, 202, 301, 3, "Cancelled", 1, "220.00"),
    ]
]


def staged(spark, patients=PATIENTS, doctors=DOCTORS, appointments=APPOINTMENTS):
    return {
        "patient": spark.createDataFrame(patients, PATIENT_SCHEMA),
        "doctor": spark.createDataFrame(doctors, DOCTOR_SCHEMA),
        "appointment": spark.createDataFrame(appointments, APPOINTMENT_SCHEMA),
    }
