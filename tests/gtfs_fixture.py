"""Tiny GTFS feeds written to a folder (FIXTURES.md section 1)."""

import os

FEEDS = {
    # A: all four files, country CH
    "A": {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n"
                     "007,Zürich HB,47.3779,8.5403\n7,Basel SBB,47.5476,7.5896\n"
                     "8503000:0:1,Genève,46.2104,6.1424\nS4,   ,46.0,7.0\nS5,Lugano,abc,8.95\nS6,Brig,46.3196,7.9882\n",
        "trips.txt": "route_id,service_id,trip_id\nR1,S,T1\nR1,S,T2\nR2,S,T3\nR1,S,T4\nR1,S,T5\nR3,S,T6\nR1,S,T7\nR1,S,T8\n",
        "routes.txt": "route_id,route_short_name\nR1,EN 123\nR2, \nR3,  Zürich HB  \n",
        "stop_times.txt": "trip_id,arrival_time,stop_id,stop_sequence\n"
                          "T1,08:00,007,1\nT1,09:00,7,2\nT1,10:00,8503000:0:1,3\n"
                          "T2,08:00,8503000:0:1,1\nT2,09:00,007,5\n"
                          "T3,08:00,S6,1\n"
                          "T4,08:00,S4,1\nT4,09:00,7,2\n"
                          "T5,08:00,S5,1\nT5,09:00,7,2\n"
                          "T6,08:00,007,x\nT6,09:00,7,1\nT6,09:30,S6,1\n"
                          "T8,08:00,7,1\nT8,09:00,ZZZ,2\n",
    },
    # B: reordered + extra columns, no country (map lookup)
    "B": {
        "stops.txt": "stop_lon,stop_name,platform_code,stop_id,stop_lat\n"
                     "2.3553,Paris Nord,1,P,48.8809\n11.5586,München Hbf,2,M,48.1402\n2.36,Nord,,N,48.88\n"
                     "12.3211,Venice Santa Lucia,,V,45.4410\n6.9583,Köln Hbf,,K,50.9430\n1.0,Nowhere,,X,1.0\n",
        "trips.txt": "trip_id,extra,route_id\nB1,x,BR1\nB2,x,BR1\nB3,x,BR2\nB4,x,BR2\n",
        "routes.txt": "route_long_name,route_id,route_short_name\nlong,BR1,NJ 40\nlong,BR2,\n",
        "stop_times.txt": "stop_sequence,stop_id,trip_id\n1,P,B1\n2,M,B1\n1,N,B2\n2,V,B2\n1,K,B3\n2,X,B3\n1,M,B4\n2,P,B4\n",
    },
    # C: no stop_times, endpoint columns in trips
    "C": {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n"
                     "L,London St Pancras International,51.5319,-0.1263\nB,Bruxelles-Midi,50.8357,4.3363\n"
                     "E,Lille Europe,50.6392,3.0755\nU,Unknownville,50.0,3.0\n",
        "trips.txt": "route_id,trip_id,start_stop_id,end_stop_id\nES,C1,L,B\nES,C2,E,U\nES,C3,L,Q\n",
        "routes.txt": "route_id,route_short_name\nES,Eurostar\n",
    },
    # D: no stop_times, no endpoint columns
    "D": {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n1,Aarhus,56.15,10.2\n",
        "trips.txt": "route_id,trip_id\nR,D1\n",
        "routes.txt": "route_id,route_short_name\nR,IC\n",
    },
    # E: routes.txt missing
    "E": {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n1,Graz Hbf,47.07,15.41\n2,Wien Hbf,48.18,16.37\n",
        "trips.txt": "route_id,trip_id\nR,E1\n",
        "stop_times.txt": "trip_id,stop_id,stop_sequence\nE1,1,1\nE1,2,2\n",
    },
    # F: same ids as A, other stations
    "F": {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon\n007,Wien Hbf,48.1852,16.3760\n7,Salzburg Hbf,47.8128,13.0459\n",
        "trips.txt": "route_id,service_id,trip_id\nR1,S,T1\n",
        "routes.txt": "route_id,route_short_name\nR1,EN 123\n",
        "stop_times.txt": "trip_id,stop_id,stop_sequence\nT1,007,1\nT1,7,2\n",
    },
}

# (feed_id, folder, kind, country)
REGISTRY = [
    ("A", "A", "night", "CH"),
    ("B", "B", "night", None),
    ("C-night", "C", "night", None),
    ("E", "E", "night", None),
    ("F", "F", "night", None),
    ("C", "C", "day", None),
    ("D", "D", "day", None),
]


def write_feeds(root: str) -> list[tuple]:
    for feed, files in FEEDS.items():
        os.makedirs(os.path.join(root, feed), exist_ok=True)
        for name, text in files.items():
            with open(os.path.join(root, feed, name), "w", encoding="utf-8") as fh:
                fh.write(text)
    return [(fid, os.path.join(root, folder), kind, country) for fid, folder, kind, country in REGISTRY]
