"""A tiny booking world for the streaming tests, written by hand."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "theatres": "theatre_id string, name string, city string, state string, screen_type string, seat_capacity int",
    "movies": "movie_id string, title string, genre string, duration_minutes int, release_date date",
    "customers": "customer_id string, name string, email string, phone string, city string, signup_date date",
    "shows": "show_id string, movie_id string, theatre_id string, showtime timestamp, screen_type string, base_price int",
    "bookings": "booking_id string, show_id string, customer_id string, seats_booked int, ticket_amount int, "
    "fees int, discount int, payment_gateway string, payment_status string, booking_channel string, "
    "is_cancelled boolean, booking_date date",
}


def theatre(key, city="Pune", capacity=10):
    return (key, f"Hall {key}", city, "Here", "IMAX", capacity)


def movie(key, minutes=120):
    return (key, f"Film {key}", "Drama", minutes, date(2026, 1, 1))


def customer(key, email="a.s@b.co", phone="9876543210", city="Pune"):
    return (key, f"Person {key}", email, phone, city, date(2025, 5, 5))


def show(key, movie_id="M1", theatre_id="T1", price=250):
    return (key, movie_id, theatre_id, datetime(2026, 7, 30, 18), "IMAX", price)


def booking(key, show_id="S1", customer_id="C1", amount=500, status="success", cancelled=False,
            day=30, seats=2, gateway="GatewayA"):
    return (key, show_id, customer_id, seats, amount, 10, 5, gateway, status, "web", cancelled,
            date(2026, 7, day))


def frame(spark: SparkSession, entity: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS[entity])


def basics(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "theatres": frame(spark, "theatres", [theatre("T1"), theatre("T2", "Mumbai", 100)]),
        "movies": frame(spark, "movies", [movie("M1"), movie("M2"), movie("M3", -1)]),
        "customers": frame(spark, "customers", [customer("C1"), customer("C2", email="broken"), customer("C3")]),
        "shows": frame(spark, "shows", [show("S1"), show("S2", "M2", "T2"), show("S9", "M9")]),
    }


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
