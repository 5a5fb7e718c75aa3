"""Fixture rows: seed data and samples (FIXTURES.md)."""

import datetime as dt

D = dt.date
TS = dt.datetime

AS_OF = D(2025, 1, 31)

# The seed rows and the dirty product file whose results the tests know.

CUSTOMERS = [(1, "Nguyen Van A", "a@example.com"), (2, "Tran Thi B", "b@example.com"),
             (3, "Le Van C", "c@example.com"), (4, "Pham Thi D", "d@example.com"),
             (5, "Hoang Van E", "e@example.com")]
PRODUCTS = [(1, "iPhone 15", "Electronics", 23000000.0), (2, "Samsung Galaxy S24", "Electronics", 21000000.0),
            (3, "MacBook Air M3", "Laptop", 32000000.0), (4, "AirPods Pro 2", "Audio", 5500000.0),
            (5, "Sony WH-1000XM5", "Audio", 9000000.0), (6, "Logitech MX Master 3", "Accessory", 2500000.0)]
ORDERS = [(1, 1, D(2025, 1, 26), "completed"), (2, 2, D(2025, 1, 29), "completed"),
          (3, 3, D(2025, 1, 21), "completed"), (4, 1, D(2025, 1, 30), "created"),
          (5, 5, D(2025, 1, 31), "created")]
ITEMS = [(1, 1, 1, 1, 23000000.0), (2, 1, 4, 1, 5500000.0), (3, 2, 3, 1, 32000000.0),
         (4, 3, 2, 1, 21000000.0), (5, 3, 6, 2, 5000000.0), (6, 4, 5, 1, 9000000.0),
         (7, 5, 6, 1, 2500000.0)]

PRODUCTS_CSV = """product_name,category,price
iPhone 15,Electronics,23000000
Samsung Galaxy S24,Electronics,21000000
MacBook Air M3,Laptop,32000000
AirPods Pro 2,Audio,5500000
Sony WH-1000XM5,Audio,9000000
Logitech MX Master 3,Accessory,2500000
,Electronics,1000000
Dirty Product,,not_a_number
Duplicate Item,Audio,5500000
Duplicate Item,Audio,5500000
  Trim Me  ,  Laptop  ,  15000000
Keyboard,Accessory,800000
"""


def retail(spark):
    c = spark.createDataFrame(CUSTOMERS, "customer_id long, full_name string, email string")
    p = spark.createDataFrame(PRODUCTS, "product_id long, product_name string, category string, price double")
    o = spark.createDataFrame(ORDERS, "order_id long, customer_id long, order_date date, status string")
    i = spark.createDataFrame(ITEMS, "order_item_id long, order_id long, product_id long, quantity int, "
                                     "subtotal double")
    return c, p, o, i
