"""The labelled table of the personal-data field: [kind:text] marks a span, the rest is outside."""

ROWS = """
Call me at [phone:555-123-4567] tomorrow
Please phone [phone:(555) 987-6543] before noon
My number is [phone:020 7946 0958] in London
Tel [phone:030-901820] or write
Fax [phone:0049 30 901820] any time
mobile [phone:0612345678] after six
Tel: [phone:01 42 68 53 00] le matin
Telefon [phone:0221 4567890] am Abend
llame al [phone:91 123 45 67] hoy
reach us on [phone:1-800-555-0199] today
phone [phone:+44 20 7946 0018] now
call [phone:+1 555 010 9999] please
cell [phone:555.867.5309] is best
dial [phone:(212) 555-0147] for help
contact [email:jane.doe@example] soon
mail [email:ops@localhost] about it
send it to [email:john@intranet] please
write to [email:anna.schmidt@firma.de] today
email [email:paul_b@mail.example.com] and wait
correo [email:luis@correo] gracias
courriel [email:marie@exemple] merci
user [email:root@server1] failed
cc [email:a.b+c@lists.example.org] too
server [ip:10.0.0.1] is down
host [ip:192.168.1.20] answered
ping [ip:172.16.254.1] twice
address [ip:8.8.8.8] replied
from [ip:203.0.113.77] to port
login from [ip:198.51.100.23] failed
ip [ip:2001:db8::1] is up
address [ip:fe80::1ff:fe23:4567:890a] replied
host [ip:2001:0db8:85a3:0000:0000:8a2e:0370:7334] answered
card [card:4111 1111 1111 1111] expired
visa [card:4111-1111-1111-1111] was used
pay with [card:5500005555555559] now
charged to [card:3782 822463 10005] yesterday
Karte [card:6011 0009 9013 9424] gesperrt
card number [card:4012.8888.8888.1881] please
in 1998 there were many
the year 2021 was long
on 12 May 2020 we met
dated 2020-05-12 and signed
on 12/05/2020 at noon
at 10:45 the train left
from 9:00 to 17:30 daily
about 1,250 people came
it cost 19.99 in total
priced at 4.50 each
version 2.10.3 is out
release 1.2.3.4.5 is old
chapter 12 section 3
pages 120-135 of the book
a 16:9 screen
weighs 3.5 kg or 7.7 lb
order 12345678 was shipped
ticket 4455 is closed
invoice 2020-0045 is due
room 101 on floor 3
route 66 is long
the ratio 3/4 is small
covid-19 in 2020
h2o and co2 rose
the 1st and the 2nd
grew by 12.5% in 2019
between 1939-1945 and after
isbn 978-3-16-148410-0 is a book
ids 1234567890123456 and 42
sum 100000000 of units
won 3-2 in the final
follow @somebody for news
thanks @team and @all
meet @ 5 today
1 2 3 4 5 6 7
see items 7 8 9 10
http://example.org/page/2 is a page
lines 10 20 30 40 50
hex 0x1F4A and 3f2b9c
9 out of 10 agree
the 90s and the 1980s
measured 5-10 times
""".strip().split("\n")
