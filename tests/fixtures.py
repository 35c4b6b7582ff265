"""Small reference-shaped fixtures (FIXTURES.md) and their goldens."""

# The 10-row sales sample and its published goldens.
SALES_HEADER = "transaction_id,store_id,product_id,product_name,category,quantity,unit_price,amount,sale_date,payment_method"
SALES_ROWS = [
    "TXN-20240115-001,STORE-JKT-01,PROD-001,Indomie Goreng,food,5,3500,17500,2024-01-15,cash",
    "TXN-20240115-002,STORE-JKT-01,PROD-002,Aqua 600ml,beverage,2,5000,10000,2024-01-15,qris",
    "TXN-20240115-003,STORE-BDG-01,PROD-003,Teh Botol Sosro,beverage,3,4500,13500,2024-01-15,debit_card",
    "TXN-20240115-004,STORE-BDG-01,PROD-004,Chitato Originale,snack,1,12000,12000,2024-01-15,cash",
    "TXN-20240115-005,STORE-SBY-01,PROD-005,Beras Premium 5kg,staple,2,65000,130000,2024-01-15,transfer",
    "TXN-20240115-006,STORE-SBY-01,PROD-001,Indomie Goreng,food,10,3500,35000,2024-01-15,qris",
    "TXN-20240115-007,STORE-MDN-01,PROD-006,Minyak Goreng 2L,staple,1,35000,35000,2024-01-15,cash",
    "TXN-20240115-008,STORE-MDN-01,PROD-007,Sabun Lifebuoy,personal_care,2,8500,17000,2024-01-15,qris",
    "TXN-20240115-009,STORE-JKT-02,PROD-008,Kopi Kapal Api,food,3,25000,75000,2024-01-15,debit_card",
    "TXN-20240115-010,STORE-JKT-02,PROD-009,Energen Coklat,food,5,7500,37500,2024-01-15,cash",
]
SALES_BY_STORE = {"STORE-SBY-01": (165000.0, 2), "STORE-JKT-02": (112500.0, 2), "STORE-MDN-01": (52000.0, 2),
                  "STORE-JKT-01": (27500.0, 2), "STORE-BDG-01": (25500.0, 2)}
SALES_BY_CATEGORY = {"food": (165000.0, 23), "staple": (165000.0, 3), "beverage": (23500.0, 5),
                     "personal_care": (17000.0, 2), "snack": (12000.0, 1)}
SALES_BY_PAYMENT = {"cash": (4, 102000.0), "qris": (3, 62000.0), "debit_card": (2, 88500.0), "transfer": (1, 130000.0)}

# The 20-row order sample (id suffix, category, total, region,
# status, payment, quantity, unit price, timestamp) and its goldens.
ORDERS = [
    ("000001", "Electronics", 350000, "jakarta", "completed", "transfer", 1, 350000, "2024-01-15T08:30:00Z"),
    ("000002", "Electronics", 360000, "surabaya", "completed", "credit_card", 2, 180000, "2024-01-15T08:45:22Z"),
    ("000003", "Food & Beverage", 225000, "bandung", "completed", "ewallet", 3, 75000, "2024-01-15T09:01:05Z"),
    ("000004", "Fashion", 1200000, "medan", "pending", "transfer", 1, 1200000, "2024-01-15T09:15:33Z"),
    ("000005", "Electronics", 650000, "jakarta", "completed", "credit_card", 1, 650000, "2024-01-15T09:30:11Z"),
    ("000006", "Health", 225000, "yogyakarta", "completed", "ewallet", 5, 45000, "2024-01-15T09:44:58Z"),
    ("000007", "Fashion", 560000, "solo", "completed", "transfer", 2, 280000, "2024-01-15T10:00:44Z"),
    ("000008", "Electronics", 350000, "jakarta", "cancelled", "credit_card", 1, 350000, "2024-01-15T10:15:02Z"),
    ("000009", "Home Appliance", 450000, "surabaya", "completed", "ewallet", 1, 450000, "2024-01-15T10:28:39Z"),
    ("000010", "Health", 640000, "bandung", "completed", "transfer", 2, 320000, "2024-01-15T10:45:17Z"),
    ("000011", "Electronics", 95000, "makassar", "completed", "ewallet", 1, 95000, "2024-01-15T11:00:55Z"),
    ("000012", "Food & Beverage", 128000, "jakarta", "completed", "transfer", 4, 32000, "2024-01-15T11:15:30Z"),
    ("000013", "Sports", 3500000, "jakarta", "pending", "credit_card", 1, 3500000, "2024-01-15T11:32:08Z"),
    ("000014", "Fashion", 780000, "semarang", "completed", "ewallet", 1, 780000, "2024-01-15T11:48:45Z"),
    ("000015", "Home Appliance", 850000, "surabaya", "completed", "transfer", 1, 850000, "2024-01-15T12:01:22Z"),
    ("000016", "Electronics", 180000, "medan", "completed", "credit_card", 1, 180000, "2024-01-15T12:20:10Z"),
    ("000017", "Food & Beverage", 85000, "jakarta", "completed", "ewallet", 10, 8500, "2024-01-15T12:35:49Z"),
    ("000018", "Sports", 185000, "bali", "completed", "transfer", 1, 185000, "2024-01-15T12:50:03Z"),
    ("000019", "Electronics", 470000, "jakarta", "completed", "ewallet", 2, 235000, "2024-01-15T13:05:37Z"),
    ("000020", "Health", 165000, "bandung", "completed", "credit_card", 3, 55000, "2024-01-15T13:22:14Z"),
]
ORDERS_BY_REGION = {"jakarta": (7, 5533000.0), "surabaya": (3, 1660000.0), "medan": (2, 1380000.0),
                    "bandung": (3, 1030000.0), "semarang": (1, 780000.0), "solo": (1, 560000.0),
                    "yogyakarta": (1, 225000.0), "bali": (1, 185000.0), "makassar": (1, 95000.0)}
ORDERS_BY_SLUG = {"sports": (2, 3685000.0), "fashion": (3, 2540000.0), "electronics": (7, 2455000.0),
                  "home_appliance": (2, 1300000.0), "health": (3, 1030000.0), "food_beverage": (3, 438000.0)}


def order_json(row, **override):
    import json
    sfx, cat, total, region, status, pay, qty, unit, ts = row
    d = {"order_id": f"ORD-20240115-{sfx}", "customer_id": f"CUST-{sfx}", "product_id": f"PROD-{sfx}",
         "product_name": f" Product {sfx} ", "category": cat, "quantity": qty, "unit_price": unit,
         "total_amount": total, "order_status": status, "payment_method": pay, "region": region, "timestamp": ts}
    d.update(override)
    return json.dumps(d)


def write_text(path, lines):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path
