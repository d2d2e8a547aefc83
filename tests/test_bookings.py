"""The load with several targets: a second run, and a job that is lost between its writes."""

import pytest

from tablebridge.plans import bookings
from tablebridge.plans.bookings import BookingLoad, Published
from tablebridge.session import cut_lineage, new_run_folder

STAGING = "booking bigint, visit_at timestamp, pid string, first_name string, last_name string, phone string, login string, channel string"
BOOKINGS = "id bigint, booking bigint, visit_at timestamp, user_id bigint, patient bigint"
PEOPLE = "id bigint, pid string, first_name string, last_name string, phone string, is_generated boolean, channel string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark):
    from datetime import datetime as dt

    at = lambda d: dt(2024, 1, d)
    staging = [
        (1, at(1), "P1", "Ann", "Bo", "0811111111", "x", "web"),
        (2, at(2), None, "Cy", "Du", "0822222222", "x", "web"),
        (3, at(3), None, "Cy", "Du", "0822222222", None, "phone"),
        (4, at(4), None, None, None, None, None, "lone"),
        (5, at(5), None, None, None, None, None, "lone"),
        (6, at(6), "P6", "Em", "Fo", "0833333333", None, "web"),
        (None, at(7), "P7", "No", "Key", None, None, None),
    ]
    bookings = [(10, 6, at(6), None, 90), (11, 99, at(9), None, 91)]
    people = [
        (1, "p1", "INFERRED", "PID p1", None, False, None), (2, "P6", "Em", "Fo", "0833333333", False, "old"),
        (90, "K90", "Em", "Fo", "0833333333", True, None), (91, "K91", "Gi", "Ha", "0844444444", True, "kept"),
    ]
    return [spark.createDataFrame(x, s) for x, s in ((staging, STAGING), (bookings, BOOKINGS), (people, PEOPLE), ([(" X", 7)], "login string, user_id bigint"))]


def test_steps_of_the_load(tables):
    load = BookingLoad(*tables, "channel")
    found = {r.booking: (r.id, r.patient, r.user_id, r.merge_action) for r in load.booking_rows.collect()}
    # A placeholder is found without regard to case, name and phone share one generated person, rows without either have their own.
    assert found == {
        6: (10, 2, None, "relinked"), 99: (11, 91, None, "kept"), 1: (12, 1, 7, "inserted"), 2: (13, 92, 7, "inserted"),
        3: (14, 92, None, "inserted"), 4: (15, 93, None, "inserted"), 5: (16, 94, None, "inserted"),
    }
    assert rows(load.people_freed) == [(90, "K90")] and load.people_made.count() == 0
    people = {r.id: r for r in load.people_rows.collect()}
    assert set(people) == {1, 2, 91, 92, 93, 94}
    assert (people[1].first_name, people[1].phone, people[1].channel) == ("Ann", "0811111111", "web")
    assert (people[92].pid, people[92].channel, people[91].channel) == ("K92", "phone", "kept")


def test_a_second_run_changes_nothing(spark, tables):
    store = Published(spark, new_run_folder(spark, "test"))
    first = BookingLoad(*tables, "channel")
    store.publish(first.outputs())
    again = BookingLoad(tables[0], store.read("bookings"), store.read("people"), tables[3], "channel")
    store.publish(again.outputs())
    assert {r.merge_action for r in again.booking_rows.collect()} <= {"unchanged", "kept", "updated"}
    assert again.people_made.count() == again.people_freed.count() == 0
    # Rows without name and phone keep the person that was made for them.
    assert again.people_generated.count() == 0
    assert all(rows(store.read(n, 1)) == rows(store.read(n, 0)) for n in ("bookings", "people"))


def test_a_lost_job_leaves_the_version_before(spark):
    store = Published(spark, new_run_folder(spark, "test"))
    table = lambda n: spark.range(n).toDF("n")
    store.publish({"a": table(1), "b": table(1)})

    class Lost:
        @property
        def write(self):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.publish({"a": table(5), "b": Lost()})
    assert [store.read(n).count() for n in ("a", "b")] == [1, 1]
    assert store.publish({"b": table(3)}) == 1
    assert [store.read(n).count() for n in ("a", "b")] == [1, 3] and [store.read(n, 0).count() for n in ("a", "b")] == [1, 1]


def test_bookings_do_without_the_names_of_generated_people(tables, monkeypatch):
    written = []
    monkeypatch.setattr(bookings, "cut_lineage", lambda df: written.append(df.columns) or cut_lineage(df))
    load = BookingLoad(*tables, "channel")
    load.booking_rows.collect()
    assert len(written) == 6
    assert load.people_generated.count() == 3 and len(written) == 7
