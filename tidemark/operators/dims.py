"""Device dimensions: which devices report, and their city, car, agent, vendor.

A device that is bound twice keeps both rows; the roll-ups count it twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cells import as_day


@dataclass(frozen=True)
class DeviceRules:
    """What makes a device count: the service tag it is bound under, the
    screen applications, and the word that marks test devices."""

    service_tag: str
    apps: tuple[str, ...]
    taxi_app: str
    vendor_app: str
    vendor_word: str
    taxi_category: str
    test_word: str = "测试"  # fixed value: "test" in a device description


def bound(service: DataFrame, info: DataFrame, rules: DeviceRules) -> DataFrame:
    """Devices bound under the service tag with a screen in service, of any application: what all dimensions start from."""
    live = service.filter((F.col("status") == 0) & (F.col("is_delete") == 0) & (F.col("tag") == rules.service_tag))
    apps = sorted({*rules.apps, rules.taxi_app, rules.vendor_app})
    # A NULL description fails the "not like" test as well.
    real = info.filter(F.col("main_app").isin(*apps) & ~F.col("desc").contains(rules.test_word))
    return live.select("third_code", "car_id", "add_time").join(
        real.select("device_name", "owner_sn", "main_app", "desc"), F.col("third_code") == F.col("device_name"), "inner").drop("device_name")


def with_car(bound: DataFrame, car: DataFrame) -> DataFrame:
    return bound.join(car.select(F.col("id").alias("car_id"), "city_sn", "car_type"), "car_id", "inner")


# The dimensions, from ``bound`` and from ``with_car``.

def agents_of(bound: DataFrame, rules: DeviceRules) -> DataFrame:
    return bound.filter(F.col("main_app").isin(*rules.apps)).select("third_code", F.col("owner_sn").alias("parent_id"))


def cities_of(cars: DataFrame, rules: DeviceRules) -> DataFrame:
    return cars.filter(F.col("main_app").isin(*rules.apps)).select("third_code", "city_sn", "car_type")


def taxis_of(cars: DataFrame, rules: DeviceRules) -> DataFrame:
    return cars.filter(F.col("main_app") == rules.taxi_app).select("third_code", "city_sn", "car_type")


def vendors_of(bound: DataFrame, rules: DeviceRules) -> DataFrame:
    kind = F.when(F.col("desc").contains(rules.vendor_word), F.lit(rules.vendor_word)).otherwise(F.lit("ELSE"))
    return bound.filter(F.col("main_app") == rules.vendor_app).select("third_code", kind.alias("type"))


def city_bindings_of(cars: DataFrame, rules: DeviceRules) -> DataFrame:
    return cars.filter(F.col("main_app").isin(*rules.apps)).select(
        "third_code", "city_sn", "car_type", as_day(F.col("add_time")).alias("bind_day"))


def agent_bindings_of(cars: DataFrame, rules: DeviceRules) -> DataFrame:
    return cars.filter(F.col("main_app").isin(*rules.apps)).select(
        "third_code", F.col("owner_sn").alias("parent_id"), as_day(F.col("add_time")).alias("bind_day"))


# The same from the device tables.

def agent_dim(service: DataFrame, info: DataFrame, rules: DeviceRules) -> DataFrame:
    return agents_of(bound(service, info, rules), rules)


def city_dim(service: DataFrame, info: DataFrame, car: DataFrame, rules: DeviceRules) -> DataFrame:
    return cities_of(with_car(bound(service, info, rules), car), rules)


def taxi_dim(service: DataFrame, info: DataFrame, car: DataFrame, rules: DeviceRules) -> DataFrame:
    return taxis_of(with_car(bound(service, info, rules), car), rules)


def vendor_dim(service: DataFrame, info: DataFrame, rules: DeviceRules) -> DataFrame:
    return vendors_of(bound(service, info, rules), rules)


def city_bindings(service: DataFrame, info: DataFrame, car: DataFrame, rules: DeviceRules) -> DataFrame:
    return city_bindings_of(with_car(bound(service, info, rules), car), rules)


def agent_bindings(service: DataFrame, info: DataFrame, car: DataFrame, rules: DeviceRules) -> DataFrame:
    return agent_bindings_of(with_car(bound(service, info, rules), car), rules)
