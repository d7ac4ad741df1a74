"""The features in plain Python, one user at a time, straight from their
definitions. Slow and obvious on purpose."""

from __future__ import annotations

import random


def random_source(seed: int, n_users: int = 12, n_products: int = 9) -> dict[str, list[tuple]]:
    """Small random source tables with repeated products and equal cart positions."""
    rng = random.Random(seed)
    products = [
        (p, f"name {p}", rng.choice([3, 5, 11]), rng.choice([1, 2])) for p in range(1, n_products + 1)
    ]
    departments = {}
    products = [(p, n, a, departments.setdefault(a, d)) for p, n, a, d in products]
    orders, prior, train = [], [], []
    order_id = 7
    for user in range(1, n_users + 1):
        n_orders = rng.randint(1, 6)
        bought = set()
        for number in range(1, n_orders + 1):
            order_id += rng.randint(1, 9)
            last = number == n_orders
            split = ("train" if user % 3 else "test") if last else "prior"
            gap = None if number == 1 else float(rng.randint(0, 30))
            orders.append(
                (order_id, user, split, number, rng.randint(0, 6), rng.randint(0, 23), gap)
            )
            if split == "test" and user % 2:
                continue
            target = train if split == "train" else prior
            basket = []
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                product = rng.randint(1, n_products)
                basket.append((order_id, product, rng.randint(1, 4), int(product in bought)))
            bought |= {line[1] for line in basket}
            target.extend(basket)
    return {"orders": orders, "products": products, "prior": prior, "train": train}


def users_of(source: dict[str, list[tuple]]) -> dict[int, list[dict]]:
    """user -> orders with items, oldest first, baskets in cart order."""
    products = {p: (aisle, dept) for p, _, aisle, dept in source["products"]}
    orders = {row[0]: row for row in source["orders"]}
    baskets: dict[int, list] = {}
    for order, product, position, flag in source["prior"] + source["train"]:
        if order in orders and product in products:
            baskets.setdefault(order, []).append((position, str(product), flag, product))
    users: dict[int, list[dict]] = {}
    for order, lines in baskets.items():
        _, user, split, number, dow, hour, gap = orders[order]
        lines.sort(key=lambda line: (line[0], line[1], str(line[2])))
        users.setdefault(user, []).append(
            {
                "id": order,
                "split": split,
                "number": number,
                "dow": dow,
                "hour": hour,
                "gap": -1 if gap is None else int(gap),
                "products": [line[3] for line in lines],
                "flags": [line[2] for line in lines],
                "aisles": [products[line[3]][0] for line in lines],
                "departments": [products[line[3]][1] for line in lines],
            }
        )
    for entries in users.values():
        entries.sort(key=lambda o: (o["number"], str(o["id"])))
    return users


def text(values) -> str:
    return " ".join(str(v) for v in values)


def nested(orders) -> str:
    return " ".join("_".join(str(v) for v in order) for order in orders)


def user_rows(users: dict[int, list[dict]]) -> list[dict]:
    return [
        {
            "user_id": user,
            "order_ids": text(o["id"] for o in orders),
            "order_numbers": text(o["number"] for o in orders),
            "order_dows": text(o["dow"] for o in orders),
            "order_hours": text(o["hour"] for o in orders),
            "days_since_prior_orders": text(o["gap"] for o in orders),
            "product_ids": nested(o["products"] for o in orders),
            "reorders": nested(o["flags"] for o in orders),
            "department_ids": nested(o["departments"] for o in orders),
            "aisle_ids": nested(o["aisles"] for o in orders),
            "eval_set": orders[-1]["split"],
        }
        for user, orders in users.items()
    ]


def temporal(orders: list[dict]) -> dict[str, str]:
    return {
        "order_dows": text(o["dow"] for o in orders),
        "order_hours": text(o["hour"] for o in orders),
        "days_since_prior_orders": text(o["gap"] for o in orders),
        "order_numbers": text(o["number"] for o in orders),
    }


def tags_of(source) -> dict[int, str]:
    return {row[1]: row[2] for row in source["orders"] if row[2] in ("train", "test")}


def product_rows(source) -> list[dict]:
    tags = tags_of(source)
    lookup = {p: (name, aisle, dept) for p, name, aisle, dept in source["products"]}
    out = []
    for user, orders in users_of(source).items():
        past, target = orders[:-1], orders[-1]
        seen: set = set()
        overlaps = []
        for order in past:
            overlaps.append(len(set(order["products"]) & seen))
            seen |= set(order["products"])
        for product in seen:
            name, aisle, dept = lookup[product]
            out.append(
                {
                    "user_id": user,
                    "product_id": product,
                    "label": int(product in target["products"])
                    if tags.get(user) == "train"
                    else -1,
                    "aisle_id": aisle,
                    "department_id": dept,
                    "product_name": name,
                    "eval_set": target["split"],
                    "is_ordered_history": text(int(product in o["products"]) for o in past),
                    "position_in_order_history": text(
                        o["products"].index(product) + 1 if product in o["products"] else 0
                        for o in past
                    ),
                    "history_order_size": text(len(o["products"]) for o in past),
                    "history_reorder_size": text(overlaps),
                    **temporal(orders),
                }
            )
    return out


def none_rows(source) -> list[dict]:
    tags = tags_of(source)
    out = []
    for user, orders in users_of(source).items():
        past, target = orders[:-1], orders[-1]
        out.append(
            {
                "user_id": user,
                "product_id": 0,
                "label": int(not any(target["flags"])) if tags.get(user) == "train" else -1,
                "aisle_id": 0,
                "department_id": 0,
                "product_name": "",
                "eval_set": target["split"],
                "is_ordered_history": text(int(not any(o["flags"])) for o in past),
                "position_in_order_history": text(0 for _ in past),
                "history_order_size": text(len(o["flags"]) for o in past),
                "history_reorder_size": text(sum(o["flags"]) for o in past),
                **temporal(orders),
            }
        )
    return out


def aisle_rows(source, departments_of_aisle: dict[int, set]) -> list[dict]:
    out = []
    for user, orders in users_of(source).items():
        past = orders[:-1]
        ranks = [list(dict.fromkeys(o["aisles"])) for o in past]
        for aisle in {a for o in past for a in o["aisles"]}:
            for department in departments_of_aisle[aisle]:
                out.append(
                    {
                        "user_id": user,
                        "aisle_id": aisle,
                        "department_id": department,
                        "eval_set": orders[-1]["split"],
                        "is_ordered_history": text(int(aisle in o["aisles"]) for o in past),
                        "position_in_order": text(
                            r.index(aisle) + 1 if aisle in r else 0 for r in ranks
                        ),
                        "num_products_from_aisle": text(o["aisles"].count(aisle) for o in past),
                        "aisle_history_size": text(len(r) for r in ranks),
                        **temporal(orders),
                    }
                )
    return out


def size_rows(source) -> list[dict]:
    out = []
    for user, orders in users_of(source).items():
        past = orders[:-1] or orders
        target = orders[-1]["flags"] if len(orders) > 1 else []
        out.append(
            {
                "user_id": user,
                "reorders_prev": [o["flags"] for o in past],
                "reorders_next": target,
                "order_sizes": [len(o["flags"]) for o in past],
                "reorder_sizes": [sum(o["flags"]) for o in past],
                "label": sum(target),
            }
        )
    return out


def padded(values: list[int], length: int) -> list[int]:
    return (values + [0] * length)[:length]


def vocabulary(names: list[str | None], min_freq: int) -> dict[str, int]:
    counts: dict[str, int] = {}
    for name in names:
        for word in (name or "").lower().split():
            counts[word] = counts.get(word, 0) + 1
    frequent = sorted((w for w in counts if counts[w] >= min_freq), key=lambda w: (-counts[w], w))
    ids = {word: i + 1 for i, word in enumerate(frequent)}
    return {word: ids.get(word, 0) for word in counts}
