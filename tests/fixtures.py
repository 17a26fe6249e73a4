"""Literal input rows for the golden tests (hand-checked answers in the tests)."""

SENSOR = [
    ("sensor_1", 1547718199, 35.8),
    ("sensor_6", 1547718201, 15.4),
    ("sensor_7", 1547718202, 6.7),
    ("sensor_10", 1547718205, 38.1),
    ("sensor_1", 1547718207, 36.3),
    ("sensor_1", 1547718209, 32.8),
    ("sensor_1", 1547718212, 37.1),
]

WORDS = ["hello hi", "hi hello", "hi c", "welcome hhh"]

LOGINS = [
    (5402, "83.149.11.115", "success", 1558430815),
    (23064, "66.249.3.15", "fail", 1558430826),
    (23064, "66.249.3.15", "fail", 1558430827),
    (5692, "80.149.25.29", "fail", 1558430833),
    (5692, "80.149.25.29", "fail", 1558430832),
    (5692, "80.149.25.29", "fail", 1558430834),
    (7233, "86.226.15.75", "success", 1558430832),
    (5692, "80.149.25.29", "success", 1558430840),
    (29607, "66.249.73.135", "success", 1558430841),
    (1035, "83.149.9.216", "fail", 1558430842),
    (1035, "83.149.9.216", "fail", 1558430843),
    (1035, "83.149.24.26", "success", 1558430847),
    (1035, "83.149.24.26", "fail", 1558430845),
    (7328, "193.114.45.13", "success", 1558430848),
    (29607, "66.249.73.135", "success", 1558430847),
    (2133, "50.16.19.13", "success", 1558430857),
    (6745, "66.249.73.185", "success", 1558430859),
    (76456, "110.136.166.128", "success", 1558430853),
    (8345, "46.105.14.53", "success", 1558430855),
    (76456, "110.136.166.128", "success", 1558430857),
    (76456, "110.136.166.128", "success", 1558430854),
    (76456, "110.136.166.128", "fail", 1558430859),
    (76456, "110.136.166.128", "success", 1558430861),
    (3464, "123.125.71.35", "success", 1558430860),
    (76456, "110.136.166.128", "success", 1558430865),
    (65322, "50.150.204.184", "success", 1558430866),
    (23565, "207.241.237.225", "fail", 1558430862),
    (8455, "200.49.190.101", "success", 1558430867),
    (8455, "200.49.190.100", "success", 1558430865),
    (8455, "200.49.190.101", "success", 1558430869),
    (8455, "200.49.190.101", "success", 1558430872),
    (32031, "66.249.73.185", "success", 1558430875),
    (12018, "66.249.73.135", "success", 1558430874),
    (12018, "66.249.73.135", "success", 1558430879),
    (12018, "66.249.73.135", "success", 1558430881),
    (21419, "67.214.178.190", "success", 1558430882),
    (21419, "67.214.178.190", "success", 1558430880),
    (23565, "207.241.237.220", "success", 1558430881),
    (2386, "46.105.14.53", "success", 1558430883),
    (23565, "207.241.237.227", "success", 1558430884),
    (83419, "91.177.205.119", "success", 1558430881),
    (83419, "91.177.205.119", "fail", 1558430882),
    (83419, "91.177.205.119", "success", 1558430885),
    (83419, "91.177.205.119", "fail", 1558430886),
    (83419, "91.177.205.119", "success", 1558430884),
    (83419, "91.177.205.119", "success", 1558430886),
    (4325, "26.249.73.15", "success", 1558430888),
    (2123, "207.241.237.228", "success", 1558430887),
    (21083, "207.241.237.101", "success", 1558430889),
    (13490, "87.169.99.232", "success", 1558430886),
    (93765, "209.85.238.199", "success", 1558430890),
    (93765, "209.85.238.199", "success", 1558430892),
]

BEHAVIOUR = [
    (1, 10, 100, "pv", 1511658000),
    (2, 10, 100, "pv", 1511658060),
    (1, 10, 100, "buy", 1511658100),
    (1, 20, 100, "pv", 1511659800),
    (2, 20, 100, "pv", 1511661599),
    (3, 10, 100, "pv", 1511661600),
]

ACCESS_LOG = [
    "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /index.html",
    "83.149.9.216 - - 17/05/2015:10:05:04 +0000 GET /site.css",
    "10.0.0.1 - - 17/05/2015:10:05:05 +0000 POST /index.html",
    "10.0.0.2 - - 17/05/2015:10:05:06 +0000 GET /a.css?x=1",
    "10.0.0.3 - - 17/05/2015:10:05:07 +0000 GET /index.html",
]
